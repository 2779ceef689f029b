"""Request rows for an external tagger, and normalising its answers.

The model call itself is outside: requests go out as rows, answers come back as
rows of JSON text.
"""

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from vacantia import fixed_values as V
from vacantia.functions.classify import lookup
from vacantia.functions.money import canonical_band
from vacantia.functions.text import grounded, head, strip


@dataclass(frozen=True)
class PromptVariant:
    """``system`` message, text before the posting, and how much description to send.

    Without a limit the description goes out whole.
    """

    system: str
    instructions: str
    empty_description: str = ""
    description_limit: int | None = None


_STRICT = (
    "Read a job posting and answer with a single JSON object. Use null for anything the "
    "posting does not state."
)
_INFER = (
    "Read a job posting and answer with a single JSON object. Choose role_family, seniority "
    "and remote_policy by closest match; copy stack, languages and visa_sponsorship only "
    "when the text shows them."
)
_FIELDS = (
    "Keys and allowed values:\n"
    f"role_family: {', '.join(V.ROLE_FAMILIES)}\n"
    f"seniority: {', '.join(V.SENIORITIES)}\n"
    f"remote_policy: {', '.join(V.REMOTE_POLICIES)}\n"
    "visa_sponsorship: true, false or null\n"
    "stack, languages: lists of words found in the text\n"
    "salary_min, salary_max: numbers or null\n"
    f"salary_currency: {', '.join(V.SALARY_CURRENCIES)}\n"
    f"salary_period: {', '.join(V.SALARY_PERIODS)}\n\n"
)
_EXAMPLE = (
    "Example:\nTitle: Senior Data Engineer\nDescription: Spark and Python, remote in Europe.\n"
    'Answer: {"role_family": "data", "seniority": "senior", "remote_policy": "remote-eu", '
    '"stack": ["Spark", "Python"]}\n\n'
)

VARIANTS = {
    "v0_current": PromptVariant(_STRICT, _FIELDS),
    "v1_differentiated": PromptVariant(_INFER, _FIELDS, V.NO_DESCRIPTION),
    "v2_few_shot": PromptVariant(_INFER, _FIELDS + _EXAMPLE, V.NO_DESCRIPTION),
}
DEFAULT_VARIANT = "v2_few_shot"


def messages(
    variant: str, title: Column, description: Column, description_limit: int | None = None
) -> Column:
    """``array<struct<role, content>>`` for one posting.

    ``description_limit`` characters of the description go out, else what the variant
    says.
    """
    if variant not in VARIANTS:
        raise ValueError(f"unknown variant {variant!r}; known: {sorted(VARIANTS)}")
    v = VARIANTS[variant]
    body = F.when(
        F.coalesce(description, F.lit("")) == "", v.empty_description
    ).otherwise(head(description, description_limit or v.description_limit))
    user = F.concat(
        F.lit(v.instructions), F.lit("Title: "), title, F.lit("\n\nDescription:\n"), body
    )
    return F.array(
        F.struct(F.lit("system").alias("role"), F.lit(v.system).alias("content")),
        F.struct(F.lit("user").alias("role"), user.alias("content")),
    )


# --- answers ------------------------------------------------------------------

# Every scalar is read as text so that a value of the wrong JSON type can be told
# apart; visa_sponsorship is strict: only a JSON boolean parses.
ANSWER_SCHEMA = """
  seniority STRING, role_family STRING, remote_policy STRING, visa_sponsorship BOOLEAN,
  stack ARRAY<STRING>, languages ARRAY<STRING>, salary_min STRING, salary_max STRING,
  salary_currency STRING, salary_period STRING
"""


def parse_answer(body: Column) -> Column:
    return F.from_json(body, ANSWER_SCHEMA)


def canonical_enum(value: Column, allowed: list[str]) -> Column:
    text = F.lower(strip(value))
    return F.when(text.isin(allowed), text)


def canonical_role(value: Column) -> Column:
    """Allowed value first, synonym second, else null."""
    text = F.lower(strip(value))
    return F.when(text.isin(V.ROLE_FAMILIES), text).otherwise(lookup(V.ROLE_SYNONYMS, text))


def normalised_answer(answer: Column, source: Column) -> dict[str, Column]:
    """Clean field columns of a parsed answer, checked against the source text."""
    return {
        "seniority": canonical_enum(answer["seniority"], V.SENIORITIES),
        "role_family": canonical_role(answer["role_family"]),
        "remote_policy": canonical_enum(answer["remote_policy"], V.REMOTE_POLICIES),
        "visa_sponsorship": answer["visa_sponsorship"],
        "stack": grounded(answer["stack"], source),
        "languages": grounded(answer["languages"], source),
        "salary": canonical_band(
            answer["salary_min"], answer["salary_max"], answer["salary_currency"],
            answer["salary_period"], source,
        ),
    }
