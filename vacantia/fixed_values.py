"""Fixed values.

Everything in this module is a value that must be exactly this for results to
be right: enum members, word lists, lookup tables, match patterns, limits.
They are stated as plain text and used by the column builders in
``vacantia.functions``; no logic lives here.
"""

# --- Fixed values: enum members ------------------------------------------------

PROVIDERS = [
    "greenhouse", "lever", "ashby", "workable", "recruitee", "personio",
    "smartrecruiters", "teamtailor", "custom_page", "workday", "phenom",
]
REMOTE_POLICIES = ["onsite", "hybrid", "remote", "remote-eu", "remote-global"]
SENIORITIES = ["intern", "junior", "mid", "senior", "staff", "principal", "exec"]
ROLE_FAMILIES = [
    "engineering", "ml-ai", "data", "product", "design", "sales", "marketing",
    "ops", "support", "finance", "legal", "hr", "research", "other",
]
SALARY_PERIODS = ["year", "month", "day", "hour"]
SALARY_CURRENCIES = [
    "EUR", "GBP", "USD", "PLN", "CHF", "SEK", "DKK", "NOK", "CZK", "HUF", "RON", "BGN",
]
SIZE_BUCKETS = ["1-10", "11-50", "51-200", "201-500", "501-1000", "1001-5000", "5001+"]
FUNDING_STAGES = [
    "bootstrapped", "pre-seed", "seed", "series-a", "series-b", "series-c",
    "series-d", "series-e+", "public", "acquired",
]
CATEGORIES = ["ai", "tech", "oss", "remote-eu", "research"]
LANE_INDUSTRIES = [
    "fashion", "beauty", "perfume", "home", "interior-design", "decoration",
    "textile", "retail-luxury",
]
SLUG_PATTERN = r"^[a-z0-9][a-z0-9\-]*$"

# --- Fixed values: sources -----------------------------------------------------

# Board readers that exist; "workable" and "teamtailor" are valid provider names
# without one, so they must surface as error rows.
BOARD_SOURCES = [
    "greenhouse", "lever", "ashby", "smartrecruiters", "recruitee", "personio",
    "custom_page", "workday", "phenom",
]
# Multi-company sources in priority order (an earlier one wins a shared URL).
AGGREGATOR_SOURCES = [
    "remoteok", "weworkremotely", "justjoinit", "wttj", "eures", "fashionjobs", "bof",
]
# The set the trends page calls "ATS"; everything else counts as aggregator.
ATS_CLASS_SOURCES = [
    "greenhouse", "lever", "ashby", "workable", "recruitee", "personio", "smartrecruiters",
]

# --- Fixed values: limits ------------------------------------------------------

SLUG_LIMIT = 48
PATH_SLUG_LIMIT = 60
PREFIXED_SLUG_LIMIT = 64
LISTING_PAGE_SIZE = 100
SEARCH_PAGE_SIZE = 25
FRONT_PAGE_COMPANY_CAP = 5
FEED_ITEMS = 50
OSS_STAR_THRESHOLD = 100

# --- Fixed values: location patterns (Unicode-aware, ignoring case) ------------

NON_EU_PLACES = (
    r"\b(USA|U\.S\.A?\.?|United States|United States of America|US\b|North America|Americas|"
    r"Latin America|LATAM|Canada|Mexico|San Francisco|San Jose|Palo Alto|Mountain View|"
    r"Sunnyvale|Berkeley|Oakland|Los Angeles|San Diego|Sacramento|New York|NYC|Brooklyn|"
    r"Manhattan|Boston|Cambridge|Chicago|Seattle|Austin|Denver|Atlanta|Miami|Portland|Phoenix|"
    r"Dallas|Houston|Toronto|Montréal|Montreal|Vancouver|Calgary|Ottawa|Pittsburgh|"
    r"Philadelphia|Washington, D\.C\.|Washington DC|Detroit|Minneapolis|St\.?\s*Louis|Tampa|"
    r"Orlando|Nashville|Charlotte|Raleigh|Salt Lake|Las Vegas|Honolulu|Anchorage|Quebec|Québec|"
    r"São Paulo|Buenos Aires|Bogotá|Bogota|Santiago|Lima|Mexico City|Guadalajara|India|"
    r"Bengaluru|Bangalore|Mumbai|Bombay|New Delhi|Delhi|Pune|Hyderabad|Chennai|Madras|Gurugram|"
    r"Gurgaon|Noida|Kolkata|Calcutta|Ahmedabad|Jaipur|Lucknow|Singapore|Singapur|Tokyo|Tōkyō|"
    r"Osaka|Yokohama|Kyoto|Nagoya|Sapporo|Japan|Beijing|Shanghai|Shenzhen|Guangzhou|Hangzhou|"
    r"Chengdu|China|Hong Kong|Macau|Taipei|Taiwan|Seoul|South Korea|Republic of Korea|Bangkok|"
    r"Thailand|Manila|Cebu|Quezon|Philippines|Jakarta|Surabaya|Indonesia|Kuala Lumpur|Penang|"
    r"Malaysia|Ho Chi Minh|Hanoi|Vietnam|Dubai|Abu Dhabi|United Arab Emirates|UAE|Sharjah|"
    r"Riyadh|Jeddah|Saudi Arabia|Doha|Qatar|Kuwait|Bahrain|Oman|Tel Aviv|Jerusalem|Haifa|Israel|"
    r"Sydney|Melbourne|Brisbane|Perth|Adelaide|Canberra|Australia|Auckland|Wellington|"
    r"New Zealand|Johannesburg|Cape Town|Pretoria|Durban|South Africa|Lagos|Nigeria|Cairo|Egypt|"
    r"Nairobi|Kenya|Casablanca|Morocco)\b"
)
US_STATE_SUFFIX = (
    r",\s*(AL|AK|AZ|AR|CA|CO|CT|DE|FL|GA|HI|ID|IL|IN|IA|KS|KY|LA|ME|MD|MA|MI|MN|MS|MO|MT|NE|NV|"
    r"NH|NJ|NM|NY|NC|ND|OH|OK|OR|PA|RI|SC|SD|TN|TX|UT|VT|VA|WA|WV|WI|WY)\b"
)
EU_OR_GLOBAL_PLACES = (
    r"\b(Europe|EU|EMEA|Worldwide|Anywhere|Global|Remote\s*[-—]\s*Worldwide|Paris|London|Berlin|"
    r"Amsterdam|Munich|München|Barcelona|Madrid|Dublin|Stockholm|Copenhagen|Helsinki|Oslo|Warsaw|"
    r"Krak[óo]w|Wroc[łl]aw|Prague|Brno|Vienna|Wien|Zurich|Zürich|Geneva|Genève|Brussels|"
    r"Bruxelles|Rome|Roma|Milan|Milano|Lisbon|Lisboa|Tallinn|Riga|Vilnius|Athens|Sofia|Budapest|"
    r"Bratislava|Ljubljana|Zagreb|Bucharest|Bucure[șs]ti|Luxembourg|Reykjavik|Reykjavík|"
    r"Manchester|Edinburgh|Glasgow|Birmingham|Hamburg|Frankfurt|Köln|Cologne|Düsseldorf|"
    r"Stuttgart|Lyon|Marseille|Toulouse|Lille|Nice|Bordeaux|Strasbourg|Rotterdam|Utrecht|"
    r"Eindhoven|Antwerp|Antwerpen|Ghent|Gent|Liège|Porto|Valencia|Sevilla|Bilbao|Naples|Napoli|"
    r"Turin|Torino|Bologna|Florence|Firenze|Tampere|Espoo|Aarhus|Bergen|Trondheim|Lund|Malmö|"
    r"Gothenburg|G[öo]teborg|France|Germany|Spain|Italy|Netherlands|Holland|Belgium|Sweden|"
    r"Denmark|Finland|Norway|Ireland|Portugal|Poland|Polska|Czechia|Czech Republic|Austria|"
    r"Österreich|Switzerland|Schweiz|Estonia|Latvia|Lithuania|Greece|Hellas|Romania|Bulgaria|"
    r"Hungary|Magyar|Slovakia|Slovenia|Croatia|Iceland|United Kingdom|England|Scotland|Wales|"
    r"Northern Ireland|UK\b|GB\b|Great Britain)\b"
)
OFF_SCOPE_TITLE = (
    r"\b(massage(\s*therapist)?|masseur|masseuse|spa\s*(therapist|attendant|technician|host)|"
    r"esthetician|nail\s*technician|hair\s*stylist|barber|barista|waiter|waitress|sommelier|"
    r"bartender|chef\s*de\s*(cuisine|partie|patisserie|rang)|sous\s*chef|line\s*cook|nanny|"
    r"babysitter|childcare\s*(worker|provider)|housekeeper|hotel\s*receptionist|valet|concierge|"
    r"doorman|bellhop|yoga\s*instructor|pilates\s*(instructor|teacher)|fitness\s*instructor|"
    r"personal\s*trainer|chiropractor|physiotherapist|kinesiologist|real\s*estate\s*agent|"
    r"insurance\s*agent|delivery\s*driver|truck\s*driver|forklift\s*(driver|operator)?|"
    r"warehouse\s*(worker|operator|associate)|packer|cleaner|janitor|security\s*guard|"
    r"guard\s*officer)\b"
)

# --- Fixed values: source gates ------------------------------------------------

EU_SIGNAL_WORDS = [
    "europe", "eu", "emea", "uk", "germany", "france", "spain", "netherlands",
    "ireland", "anywhere", "worldwide", "remote",
]
TECH_TITLE = (
    r"\b(engineer|engineering|developer|software|backend|frontend|fullstack|full[ -]?stack|"
    r"devops|sre|cloud|platform|infrastructure|architect|data|machine\s*learning|ml\s|\bai\b|llm|"
    r"nlp|product|design|ux|ui|sales|account|marketing|growth|content|seo|sem|finance|controller|"
    r"hr|recruit|talent|people|operations|\bops\b|legal|counsel|consultant|business|customer|"
    r"support|qa|security|research|scientist|analyst|technicien|technique|tech|saas|mobile|"
    r"cybersec)\b"
)
TECH_SECTOR_WORDS = [
    "tech", "saas", "data", "ai", "fintech", "edtech", "healthtech", "biotech", "mobility",
    "marketplace", "consulting", "cyber", "communication", "media", "industrie", "industry",
    "logistique", "logistics", "advertising", "transport",
]
LANE_SECTORS = ["Fashion / Luxury / Beauty / Lifestyle"]
LISTING_LANGUAGES = ["en", "fr", "es", "cs", "sk"]
REMOTE_GLOBAL_TEXT = r"\b(worldwide|global|anywhere|fully\s*remote)\b"
REMOTE_EU_TEXT = r"\b(remote.*(europe|emea|eu)|europe.*remote|emea.*remote)\b"
EU_COUNTRY_TEXT = (
    r"\b(France|United Kingdom|Germany|Italy|Spain|Netherlands|Belgium|Sweden|Denmark|Finland|"
    r"Norway|Ireland|Portugal|Poland|Czechia|Czech Republic|Austria|Switzerland|Estonia|"
    r"Lithuania|Latvia|Greece|Romania|Bulgaria|Hungary|Slovakia|Slovenia|Croatia|Luxembourg|"
    r"Iceland|Cyprus|Malta|Ukraine)\b"
)
EU_COUNTRY_CODES = {
    "France": "FR", "United Kingdom": "GB", "Germany": "DE", "Italy": "IT", "Spain": "ES",
    "Netherlands": "NL", "Belgium": "BE", "Sweden": "SE", "Denmark": "DK", "Finland": "FI",
    "Norway": "NO", "Ireland": "IE", "Portugal": "PT", "Poland": "PL", "Czechia": "CZ",
    "Czech Republic": "CZ", "Austria": "AT", "Switzerland": "CH", "Estonia": "EE",
    "Lithuania": "LT", "Latvia": "LV", "Greece": "GR", "Romania": "RO", "Bulgaria": "BG",
    "Hungary": "HU", "Slovakia": "SK", "Slovenia": "SI", "Croatia": "HR", "Luxembourg": "LU",
    "Iceland": "IS", "Cyprus": "CY", "Malta": "MT", "Ukraine": "UA",
}
EU_COMPANY_WORDS = [
    "france", "paris", "lyon", "marseille", "germany", "berlin", "munich", "münchen", "hamburg",
    "frankfurt", "uk", "united kingdom", "london", "manchester", "edinburgh", "spain", "madrid",
    "barcelona", "italy", "milan", "rome", "netherlands", "amsterdam", "rotterdam", "belgium",
    "brussels", "antwerp", "sweden", "stockholm", "denmark", "copenhagen", "finland", "helsinki",
    "norway", "oslo", "ireland", "dublin", "portugal", "lisbon", "poland", "warsaw", "krakow",
    "kraków", "czech", "prague", "austria", "vienna", "wien", "switzerland", "zurich", "zürich",
    "geneva", "estonia", "tallinn", "latvia", "riga", "lithuania", "vilnius", "greece", "athens",
    "romania", "bucharest", "bulgaria", "sofia", "hungary", "budapest", "slovakia", "bratislava",
    "slovenia", "ljubljana", "croatia", "zagreb", "luxembourg", "iceland", "reykjavik",
]
# First substring found in this order decides; case matters.
PLACE_TO_CODE = {
    "France": "FR", "Paris": "FR", "Germany": "DE", "Berlin": "DE", "Munich": "DE",
    "United Kingdom": "GB", "UK": "GB", "London": "GB", "Spain": "ES", "Madrid": "ES",
    "Barcelona": "ES", "Netherlands": "NL", "Amsterdam": "NL", "Sweden": "SE",
    "Stockholm": "SE", "Ireland": "IE", "Dublin": "IE", "Italy": "IT", "Milan": "IT",
    "Portugal": "PT", "Lisbon": "PT", "Poland": "PL", "Warsaw": "PL", "Czech": "CZ",
    "Prague": "CZ", "Austria": "AT", "Vienna": "AT", "Switzerland": "CH", "Zurich": "CH",
    "Zürich": "CH", "Estonia": "EE", "Tallinn": "EE", "Lithuania": "LT", "Vilnius": "LT",
    "Latvia": "LV", "Riga": "LV", "Belgium": "BE", "Brussels": "BE", "Denmark": "DK",
    "Copenhagen": "DK", "Finland": "FI", "Helsinki": "FI", "Norway": "NO", "Oslo": "NO",
    "Romania": "RO", "Greece": "GR", "Bulgaria": "BG",
}

# --- Fixed values: country and city names --------------------------------------

COUNTRY_NAMES = {
    "FR": "France", "DE": "Germany", "GB": "United Kingdom", "ES": "Spain", "IT": "Italy",
    "NL": "Netherlands", "BE": "Belgium", "SE": "Sweden", "DK": "Denmark", "FI": "Finland",
    "NO": "Norway", "IE": "Ireland", "PT": "Portugal", "PL": "Poland", "CZ": "Czechia",
    "AT": "Austria", "CH": "Switzerland", "EE": "Estonia", "LT": "Lithuania", "LV": "Latvia",
    "GR": "Greece", "RO": "Romania", "BG": "Bulgaria", "HU": "Hungary", "SK": "Slovakia",
    "SI": "Slovenia", "HR": "Croatia", "LU": "Luxembourg", "IS": "Iceland", "CY": "Cyprus",
    "MT": "Malta", "US": "United States", "CA": "Canada", "IL": "Israel", "UA": "Ukraine",
    "XX": "Remote / unknown",
}
EU_HQ_COUNTRIES = [
    "FR", "DE", "GB", "ES", "IT", "NL", "BE", "SE", "DK", "FI", "NO", "IE", "PT", "PL", "CZ",
    "AT", "CH", "EE", "LT", "LV", "GR", "RO", "BG", "HU", "SK", "SI", "HR", "LU", "IS", "CY",
    "MT", "UA",
]
# Order matters: the first city of this table found among the tokens wins.
# Cities with a space or a letter outside the token alphabet can never match
# and are left out.
CITIES_BY_COUNTRY = {
    "United Kingdom": ["london", "manchester", "edinburgh", "birmingham", "glasgow", "bristol",
                       "cambridge", "leeds"],
    "Germany": ["berlin", "munich", "münchen", "hamburg", "frankfurt", "köln", "cologne",
                "düsseldorf", "stuttgart", "leipzig", "dresden", "nuremberg", "hannover"],
    "France": ["paris", "lyon", "marseille", "toulouse", "lille", "nice", "bordeaux",
               "strasbourg", "nantes", "saint-denis", "rennes"],
    "Spain": ["madrid", "barcelona", "valencia", "sevilla", "seville", "bilbao", "malaga"],
    "Italy": ["rome", "roma", "milan", "milano", "naples", "napoli", "turin", "torino",
              "bologna", "florence", "firenze"],
    "Netherlands": ["amsterdam", "rotterdam", "utrecht", "eindhoven"],
    "Belgium": ["brussels", "bruxelles", "antwerp", "antwerpen", "ghent", "gent", "liège",
                "liege"],
    "Sweden": ["stockholm", "gothenburg", "göteborg", "malmö", "malmo", "lund"],
    "Denmark": ["copenhagen", "aarhus"],
    "Finland": ["helsinki", "espoo", "tampere"],
    "Norway": ["oslo", "bergen", "trondheim"],
    "Ireland": ["dublin", "cork", "galway"],
    "Portugal": ["lisbon", "lisboa", "porto"],
    "Poland": ["warsaw", "warszawa", "krakow", "wroclaw", "gdansk"],
    "Czechia": ["prague", "praha", "brno"],
    "Austria": ["vienna", "wien", "graz"],
    "Switzerland": ["zurich", "zürich", "geneva", "genève", "basel", "lausanne", "bern"],
    "Estonia": ["tallinn"],
    "Latvia": ["riga"],
    "Lithuania": ["vilnius", "kaunas"],
    "Greece": ["athens", "thessaloniki"],
    "Romania": ["bucharest"],
    "Bulgaria": ["sofia"],
    "Hungary": ["budapest"],
    "Slovakia": ["bratislava"],
    "Slovenia": ["ljubljana"],
    "Croatia": ["zagreb"],
    "Cyprus": ["limassol", "nicosia"],
    "Luxembourg": ["luxembourg"],
    "Iceland": ["reykjavik"],
}
PLACE_TOKEN_SEPARATOR = r"[^a-zàâäéèêëïîôöùûüçœæñ\-]+"
WHERE_WORLDWIDE = "Remote — Worldwide"
WHERE_EUROPE = "Remote — Europe"
WHERE_REMOTE = "Remote — unspecified"
WHERE_OTHER = "Other"
WHERE_WORLDWIDE_TEXT = r"anywhere in the world|worldwide|world\s*wide|global"
WHERE_EUROPE_TEXT = r"\beurope\b|\bemea\b|\beu\b|remote\s*[-—]\s*eu"

# --- Fixed values: title rules (ASCII word boundaries, ignoring case) ----------

EMPLOYMENT_RULES = [
    ("internship",
     r"\b(intern|interns|internship|stagiaire|stagiaires|stagista|trainee|trainees|praktikum|"
     r"praktikant|praktikantin)\b"),
    ("apprenticeship",
     r"\b(alternan(?:t|ts|ce|te|tes)|apprentic(?:e|es|eship)|ausbildung|werkstudent|"
     r"werkstudentin|lehre|lehrling|apprenti|apprentie)\b"),
    ("freelance",
     r"\b(freelance|freelancer|freelancers|freelancing|contractor|contractors)\b"),
]
ROLE_RULES = [
    ("hr",
     r"\b(recruit(er|ers|ing|ment)?|talent\s*acquisition|talent\s*partner|talent\s*lead|"
     r"people\s*partner|people\s*ops|people\s*operations|hr\s*business|hrbp|head\s*of\s*hr|"
     r"hr\s*manager|hr\s*coordinator|head\s*of\s*people|chief\s*people|head\s*of\s*talent|chro)\b"),
    ("ml-ai",
     r"\b(machine\s*learning|ml\s*engineer|ml\s*ops|mlops|ai\s*engineer|ai\s*scientist|llm|nlp|"
     r"computer\s*vision|deep\s*learning|applied\s*ai|generative\s*ai|gen\s*ai|"
     r"prompt\s*engineer)\b"),
    ("data",
     r"\b(data\s*analyst|data\s*engineer|data\s*scientist|analytics\s*engineer|"
     r"analytics\s*manager|business\s*intelligence|\bbi\s*(developer|engineer|analyst))\b"),
    ("product",
     r"\b(product\s*manager|product\s*owner|product\s*lead|product\s*marketing|"
     r"head\s*of\s*product|chief\s*product|cpo|associate\s*product|technical\s*product)\b"),
    ("design",
     r"\b(designer|design\s*lead|ux\b|ui\b|user\s*experience|user\s*interface|visual\s*design|"
     r"brand\s*design|product\s*design|graphic\s*design|ux\/ui)\b"),
    ("marketing",
     r"\b(marketing|growth\s*(manager|lead|hacker)|seo\s*(manager|specialist)?|sem|"
     r"content\s*(manager|writer|strategist)|community\s*manager|brand\s*(manager|lead)|"
     r"demand\s*generation|digital\s*marketing|social\s*media\s*(manager|lead)|"
     r"marketing\s*manager|cmo)\b"),
    ("sales",
     r"\b(sales|account\s*executive|\bae\b|sdr|bdr|account\s*manager|business\s*development|"
     r"customer\s*success|partnerships?\s*manager|key\s*account|inside\s*sales|outside\s*sales|"
     r"territory\s*manager|sales\s*development)\b"),
    ("finance",
     r"\b(finance|accounting|accountant|controller|fp&a|treasurer|tax\s*(manager|specialist)?|"
     r"audit\s*(manager|specialist)?|cfo|head\s*of\s*finance|payroll\s*specialist)\b"),
    ("legal",
     r"\b(legal\s*counsel|general\s*counsel|legal\s*manager|compliance\s*(officer|manager)|"
     r"privacy\s*(officer|counsel)|regulatory|paralegal|gdpr)\b"),
    ("support",
     r"\b(customer\s*service|customer\s*support|technical\s*support|helpdesk|help\s*desk|"
     r"onboarding\s*specialist|support\s*engineer|support\s*specialist|customer\s*operations)\b"),
    ("research",
     r"\b(research\s*scientist|research\s*engineer|research\s*lead|principal\s*researcher|"
     r"phd\s*scientist|scientific\s*officer)\b"),
    ("engineering",
     r"\b(engineer|engineering|developer|swe\b|software|backend|frontend|front-end|back-end|"
     r"fullstack|full-stack|full\s*stack|devops|sre\b|site\s*reliability|platform\s*engineer|"
     r"qa\s*engineer|security\s*engineer|architect|tech\s*lead|cto)\b"),
    ("ops",
     r"\b(operations|\bops\b|coordinator|administrator|project\s*manager|program\s*manager|pmo|"
     r"chief\s*of\s*staff|business\s*operations|revenue\s*operations|revops)\b"),
]
REMOTE_RULES = [
    ("remote-eu",
     r"\b(remote.{0,4}(eu|europe|emea)|eu.{0,4}remote|europe.{0,4}remote|emea.{0,4}remote)\b"),
    ("remote-global",
     r"\b(remote.{0,4}(global|worldwide|world\s*wide|anywhere)|fully\s*remote|100%\s*remote|"
     r"distributed)\b"),
    ("hybrid", r"\b(hybrid|hybride|2\s*days|3\s*days)\b"),
    ("onsite", r"\b(on.?site|in.?office|in.?person|presencial)\b"),
    ("remote", r"\b(remote|teleworking|tele.?work|home.?office|wfh)\b"),
]
LANE_ROLE_PATTERNS = [
    r"\bacheteur(?:s|ses)?\b",
    r"\bacheteuse(?:s)?\b",
    r"\bresponsable\s+(?:des\s+)?(?:achat|achats|sourcing|approvisionnement|gamme|offre|offres|"
    r"produit|produits|collection|collections|categorie|catégorie|category|merchandising)\b",
    r"\b(?:directeur|directrice)\s+(?:des\s+)?(?:achat|achats|sourcing|produit|produits|"
    r"merchandising|offre|offres|categorie|catégorie|collection|category)\b",
    r"\bchef(?:fe)?\s+(?:de|des)\s+(?:produit|produits|marche|marché|gamme|categorie|catégorie|"
    r"category|collection)\b",
    r"\b(?:senior|junior|head\s+of|chief|lead)?\s*(?:buyer|buying|purchaser|purchasing)\b",
    r"\b(?:product|category|brand|merchandising|assortment|sourcing|procurement)\s+"
    r"(?:manager|director|lead|head|specialist|coordinator)\b",
    r"\b(?:head|director|chief)\s+of\s+(?:product|category|brand|merchandising|assortment|"
    r"sourcing|procurement|buying|purchasing)\b",
    r"\bmerchandiser\b",
    r"\bproduct\s+(?:manager|owner|lead)\b",
]
LANE_EXCLUDED_TITLE = (
    r"\bstage\b|\bstagiaire(?:s|e|es)?\b|\bstg\b|\binternship\b|\bintern(?:s)?\b|\btrainee\b|"
    r"\bpraktikum\b|\bwerkstudent(?:in)?\b|\balternance\b|\balternant(?:e|s|es)?\b|"
    r"\bapprenti(?:e|s|es)?\b|\bapprentice(?:ship)?\b|\bausbildung\b|\blehrling\b|\bjunior\b|"
    r"\bjr\.?\b|\balt\b\.?|\balt\.?\s+|\balt-|\bassistant(?:e|s|es)?\b|\bassistante?s?\b|\bcdd\b"
)
LANE_EXCLUDED_COMPANY = "chanel"
LANE_COMPANY_PREFIX = r"^(wttj|wttjc|fjr)-"

# --- Fixed values: text sections, tagging, search ------------------------------

BOILERPLATE_TRIGGERS = [
    r"about\s+(?:us|the\s+team|the\s+company)\b",
    r"(equal\s+opportunity|diversity\s+and\s+inclusion|d&i)\b",
    r"benefits?\b",
    r"why\s+work\s+(?:with|at)\s+us\b",
]
ROLE_SYNONYMS = {
    "engineer": "engineering", "developer": "engineering", "dev": "engineering",
    "swe": "engineering", "software engineering": "engineering", "software": "engineering",
    "devops": "engineering", "ml": "ml-ai", "ai": "ml-ai", "ml/ai": "ml-ai", "ai/ml": "ml-ai",
    "machine learning": "ml-ai", "machine-learning": "ml-ai", "ai engineering": "ml-ai",
    "data engineering": "data", "data science": "data", "data engineer": "data",
    "data scientist": "data", "analytics": "data", "product management": "product",
    "pm": "product", "designer": "design", "ux": "design", "ui": "design", "ux/ui": "design",
    "graphic design": "design", "ae": "sales", "sdr": "sales", "bdr": "sales",
    "account executive": "sales", "business development": "sales", "growth": "marketing",
    "operations": "ops", "customer success": "support", "cs": "support",
    "accounting": "finance", "compliance": "legal", "people": "hr", "talent": "hr",
    "recruiting": "hr", "recruiter": "hr", "people operations": "hr", "researcher": "research",
}
SEARCH_SYNONYMS = {
    "hr": "HR Human Resources Recruiter Recruitment Recruiting Talent Acquisition "
          "People Operations People Partner Talent Partner Hiring",
    "engineering": "Engineer Software Backend Frontend Full Stack Developer Programmer Coder",
    "ml-ai": "Machine Learning Artificial Intelligence ML AI Data Science Researcher MLOps LLM",
    "data": "Data Analyst Analytics BI Business Intelligence Data Engineer Data Scientist",
    "product": "Product Manager PM Owner Product Marketing Strategy",
    "design": "Designer UX UI Visual Brand Product Designer Graphic",
    "marketing": "Marketing Growth Brand Content SEO SEM Demand Generation Performance",
    "sales": "Sales Account Executive AE Account Manager BDR SDR Business Development "
             "Customer Success Partnerships",
    "ops": "Operations Ops Project Program Manager PMO Coordinator Administrator",
    "finance": "Finance Accounting Controller FP&A Treasurer Tax Audit",
    "legal": "Legal Counsel Compliance Privacy Regulatory Lawyer Paralegal",
    "support": "Support Customer Service Technical Support Helpdesk Onboarding",
    "research": "Research Scientist Researcher PhD Scientific R&D",
}
SENIORITY_SYNONYMS = {
    "lead": "Lead Principal Staff Director Head",
    "senior": "Senior Sr",
    "junior": "Junior Jr Entry Graduate Grad",
    "mid": "Mid-level Mid",
}
ROLE_LABELS = {
    "engineering": "Engineering", "ml-ai": "ML / AI", "data": "Data", "product": "Product",
    "design": "Design", "sales": "Sales", "marketing": "Marketing", "ops": "Ops",
    "hr": "HR / Recruiting", "support": "Support", "finance": "Finance", "legal": "Legal",
    "research": "Research",
}
CURRENCY_SIGNS = {
    "EUR": "€", "GBP": "£", "USD": "$", "PLN": "zł", "CHF": "CHF", "SEK": "kr", "DKK": "kr",
    "NOK": "kr",
}
PERIOD_SUFFIXES = {"month": "/mo", "day": "/d", "hour": "/h"}
REMOTE_LABELS = {
    "remote-global": "REMOTE-WW", "remote-eu": "REMOTE-EU", "remote": "REMOTE",
    "hybrid": "HYBRID",
}
NO_DESCRIPTION = "(no description provided — infer from title alone where possible)"

# --- Fixed values: links and discovery -----------------------------------------

KNOWN_BOARD_HOSTS = [
    "greenhouse.io", "lever.co", "ashbyhq.com", "workday.com", "myworkdayjobs.com",
    "workable.com", "smartrecruiters.com", "recruitee.com", "personio.com", "personio.de",
]
SKIPPED_LINK_PARTS = [
    "github.com", "githubusercontent", "twitter.com", "linkedin.com", "youtube.com",
    "wikipedia.org", "shields.io", "/issues", "/pulls", "#",
]
OSS_LANGUAGES = [
    "Python", "TypeScript", "JavaScript", "Go", "Rust", "C++", "C", "Java", "Kotlin", "Swift",
    "Ruby", "Elixir", "Erlang", "Haskell", "Clojure", "Scala", "OCaml", "Zig", "Nim", "Crystal",
]
REPO_OWNER_BLOCKLIST = [
    "google", "facebook", "microsoft", "openai", "meta", "amazon", "nvidia", "intel", "ibm",
    "apple", "tensorflow", "pytorch", "huggingface", "kubernetes", "kubernetes-sigs", "cncf",
    "torvalds",
]
MODEL_ORG_BLOCKLIST = [
    "huggingfaceh4", "google", "facebook", "microsoft", "openai", "meta", "amazon", "nvidia",
    "intel", "ibm", "apple", "stable-diffusion-v1-5", "kaggle", "pytorch", "tensorflow",
    "anonymous", "bert-base-uncased", "stabilityai-internal",
]
GREETING_WORDS = ["hi", "hey", "hello", "we", "the", "i'm", "we're"]
LEADING_NAME = r"^([A-Z][A-Za-z0-9 &.\-/]{1,30}?)\s*(?:[|—\-:]|<|$)"
MARKDOWN_LINK = r"\[([^\]]{2,80})\]\((https?://[^\s\)]+)\)"
WORKDAY_HOST = r"https?://([a-z0-9-]+)\.(wd[0-9]+)\.myworkdayjobs\.com"
WORKDAY_SITE = r"cxs/([a-z0-9_-]+)/([A-Za-z0-9_-]+)/jobs"
FASHION_OFFER = r'href="(https?://[^/]*fashionjobs\.com/emploi/([^/]+)/([^",]+),(\d+)\.html)"'
LISTING_TITLE = (
    r'<a[^>]*href="\s*(/careers/job/\d+/[^"]+)\s*"[^>]*>\s*<span>([^<]+)</span>'
)
LISTING_LOCATION = r'lister__meta-item--location">([^<]+)</li>'
LISTING_BRAND = r'alt="([^"]+) logo"'
LISTING_BASE = "https://www.businessoffashion.com"
