"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a probability, a logistic function of
its words and word beginnings; the document's score is their noisy-or, one minus the
product of what is left of each. Only documents are labelled: the likelihood of their
labels trains the sentence model, which then also tells the offending sentences.

Scores depend on the text alone. Rows with crc32 of the id's text divisible by 5 are held
out. The model is fitted on at most ``SAMPLE_ROWS`` of the other labelled rows, those with
the smallest hashes of their ids, whose whole texts have at most ``SAMPLE_BYTES`` bytes
together: a text of any length is learnt from as long as it fits into what is left of these.
All rows are scored over their whole texts.

Defined cases: a null or empty text is one empty sentence; a row without an id is not held
out and not learnt from; a label that is null or neither 0 nor 1 is no label, and of
several labels of an id the largest counts; equal rows are learnt from once; with labels of one kind only (or none) every
score is the share of 1 among them (0).
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from vacantia.llm.arrays import U64, Words, expand, mix, parts
from vacantia.llm.contamination import free_name, lower_words, member

SAMPLE_ROWS = 6_000
SAMPLE_BYTES = 24 << 20
FIT_ROWS = 500  # rows looked at together while fitting
FIT_BYTES = 2 << 20  # and bytes, where they are more than one row
FEATURES = 4096
PREFIXES = (4, 5, 6)  # bytes of a word's beginning that are features besides the word
LEAST_DOCS = 3
LEAST_Z = 4.0
ROUNDS = 400
RATE = 0.1
DECAY = 1e-4
PART_BYTES = 1 << 20
OFFENDING = 0.5

_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?\n")] = True

FOUND = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField(
            "sentences",
            T.ArrayType(
                T.StructType(
                    [T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                     T.StructField("score", T.DoubleType())]
                )
            ),
        ),
    ]
)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


class Sentences:
    """The words of some texts with their features, and the sentences they lie in.

    Sentences are numbered through all texts; each text has one at least.
    """

    def __init__(self, column: pa.Array):
        self.words: Words = lower_words(column)
        w = self.words
        self.offsets = np.r_[0, np.cumsum(_byte_sizes(column))]
        end = _ENDS[w.buf]
        upto = np.r_[0, np.cumsum(end)]
        text = np.arange(len(self.offsets) - 1)
        # Sentences before each text: its ends and one more for each text.
        self.first = upto[self.offsets] + np.arange(len(self.offsets))
        self.count = np.diff(self.first)
        self.of_word = upto[w.start] + w.text
        self.text = np.repeat(text, self.count)
        self.cuts = np.flatnonzero(end)
        self.distinct, self.number = np.unique(w.hash, return_inverse=True)

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """(distinct word, feature) of every distinct word: itself and its beginnings."""
        w = self.words
        sample = np.zeros(len(self.distinct), np.int64)
        sample[self.number] = np.arange(len(w.hash))
        start, size = w.start[sample], (w.end - w.start)[sample]
        padded = np.r_[w.buf, np.zeros(8, np.uint8)]
        eight = np.ndarray((len(w.buf) + 1,), "<u8", buffer=padded, strides=(1,))[start] if len(start) else start.astype(U64)
        word, value = [np.arange(len(start))], [self.distinct]
        for n in PREFIXES:
            some = np.flatnonzero(size > n)
            word.append(some)
            value.append(mix((eight[some] & U64((1 << 8 * n) - 1)) * U64(2) + U64(n << 56 | 1)))
        return np.concatenate(word), np.concatenate(value)

    def span(self, sentence: int) -> tuple[int, int]:
        """Byte range of a sentence, its ending byte included."""
        t = int(self.text[sentence])
        k = sentence - int(self.first[t])
        cut = sentence - t  # ends before it: one for each earlier sentence that is no text's last
        begin = int(self.offsets[t]) if k == 0 else int(self.cuts[cut - 1]) + 1
        last = sentence == int(self.first[t + 1]) - 1
        return begin, int(self.offsets[t + 1]) if last else int(self.cuts[cut]) + 1


def _byte_sizes(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64)


@dataclass
class Model:
    features: np.ndarray  # sorted
    weights: np.ndarray
    bias: float

    def sentence_logits(self, s: Sentences) -> np.ndarray:
        out = np.full(int(s.first[-1]), self.bias)
        if len(self.features) and len(s.number):
            word, value = s.features()
            at = np.minimum(np.searchsorted(self.features, value), len(self.features) - 1)
            weight = np.where(self.features[at] == value, self.weights[at], 0.0)
            of_word = np.bincount(word, weight, len(s.distinct))
            out += np.bincount(s.of_word, of_word[s.number], len(out))
        return out


def noisy_or(logits: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Score of each text from its sentences' logits."""
    left = -np.logaddexp(0, logits)  # log of 1 - p
    return -np.expm1(np.add.reduceat(left, first[:-1])) if len(first) > 1 else np.zeros(0)


def _steps(texts: pa.Array) -> list[tuple[int, int]]:
    """First row and number of the rows that are looked at together."""
    out, begin, held = [], 0, 0
    for i, size in enumerate(_byte_sizes(texts).tolist()):
        if i > begin and (i - begin == FIT_ROWS or held + size > FIT_BYTES):
            out.append((begin, i - begin))
            begin, held = i, 0
        held += size
    return [*out, (begin, len(texts) - begin)]


def _document_counts(s: Sentences, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of some texts, how many of these have each, and how many with label 1."""
    word, value = s.features()
    known, feature = np.unique(value, return_inverse=True)
    order = np.argsort(word, kind="stable")
    bounds = np.searchsorted(word[order], np.arange(len(s.distinct) + 1))
    pair = np.unique(s.words.text * max(1, len(s.distinct)) + s.number)
    doc, of = pair // max(1, len(s.distinct)), pair % max(1, len(s.distinct))
    slot, at = expand(bounds[of], np.diff(bounds)[of])
    pair = np.unique(feature[order[slot]] * len(y) + doc[at])
    in_doc, label = pair // len(y), y[pair % len(y)]
    return known, np.bincount(in_doc, minlength=len(known)), np.bincount(in_doc, label, len(known))


def fit(texts: pa.Array, labels: np.ndarray) -> Model:
    y = np.asarray(labels, np.float64)
    share = y.mean() if len(y) else 0.0
    none = np.zeros(0, U64)
    if share in (0.0, 1.0):
        return Model(none, np.zeros(0), 40.0 if share else -800.0)
    # Documents of each kind that a feature is in, some documents at a time.
    steps = _steps(texts)
    counted = [_document_counts(Sentences(texts.slice(a, n)), y[a : a + n]) for a, n in steps]
    known, at = np.unique(np.concatenate([c[0] for c in counted]), return_inverse=True)
    total = np.bincount(at, np.concatenate([c[1] for c in counted]))
    ones = np.bincount(at, np.concatenate([c[2] for c in counted]))
    z = (ones - total * share) / np.sqrt(total * share * (1 - share))
    use = np.flatnonzero((total >= LEAST_DOCS) & (np.abs(z) >= LEAST_Z))
    use = np.sort(use[np.argsort(-np.abs(z[use]), kind="stable")[:FEATURES]])
    chosen = known[use]
    del counted, known, at
    # Entries (sentence, chosen feature) of all words, and the text of each sentence.
    rows, columns, texts_of, count, base = [], [], [], [], 0
    for a, n in steps:
        s = Sentences(texts.slice(a, n))
        word, value = s.features()
        hit, place = member(value, chosen)
        word, place = word[hit], place[hit]
        order = np.argsort(word, kind="stable")
        bounds = np.searchsorted(word[order], np.arange(len(s.distinct) + 1))
        slot, which = expand(bounds[s.number], np.diff(bounds)[s.number])
        rows.append(s.of_word[which] + base)
        columns.append(place[order[slot]])
        texts_of.append(s.text + a)
        count.append(s.count)
        base += len(s.text)
    row, column = np.concatenate(rows), np.concatenate(columns)
    text_of, count = np.concatenate(texts_of), np.concatenate(count)
    # Only sentences with a chosen feature differ; the others of a text are counted.
    some, row = np.unique(row, return_inverse=True)
    text = text_of[some]
    blank = count - np.bincount(text, minlength=len(y))
    w, bias = np.zeros(len(use)), -np.log(count.mean() / max(share, 1e-3) + 1)
    speed, force, b_speed, b_force = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, ROUNDS + 1):
        logit = np.bincount(row, w[column], len(some)) + bias
        left = np.bincount(text, -np.logaddexp(0, logit), len(y)) - blank * np.logaddexp(0, bias)
        left = np.minimum(left, -1e-12)
        pull = np.where(y > 0, -np.exp(left) / -np.expm1(left), 1.0) / len(y)
        p = 1 / (1 + np.exp(-logit))
        by_sentence = pull[text] * p
        grad = np.bincount(column, by_sentence[row], len(w)) + DECAY * w / len(y) * 100
        b_grad = by_sentence.sum() + (pull * blank).sum() / (1 + np.exp(-bias))
        speed, force = 0.9 * speed + 0.1 * grad, 0.999 * force + 0.001 * grad**2
        b_speed, b_force = 0.9 * b_speed + 0.1 * b_grad, 0.999 * b_force + 0.001 * b_grad**2
        a, c = 1 - 0.9**step, 1 - 0.999**step
        w = w - RATE * (speed / a) / (np.sqrt(force / c) + 1e-8)
        bias -= RATE * (b_speed / a) / (np.sqrt(b_force / c) + 1e-8)
    return Model(chosen, w, float(bias))


def train(
    docs: DataFrame, labels: DataFrame, *, rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES
) -> Model:
    marked = (
        labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__id"))
        .agg(F.max("toxic").cast("int").alias("__toxic"))
    )
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("__hash")).filter(~held_out())
    # The sample is chosen by id and size first, so that only its texts are moved.
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size")
    first = (
        texts.select("doc_id", "__hash", size).join(marked, F.col("doc_id") == F.col("__id"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "__hash").limit(rows).collect()
    )
    chosen, free = {}, most_bytes
    for r in first:
        key = (r["__id"], r["__hash"])
        if key not in chosen and r["size"] <= free:
            chosen[key] = r["__toxic"]
            free -= r["size"]
    sample = docs.sparkSession.createDataFrame(
        [(*k, y) for k, y in chosen.items()], "__id long, __of long, __toxic int"
    )
    chosen_texts = (
        texts.join(F.broadcast(sample), (F.col("doc_id") == F.col("__id")) & (F.col("__hash") == F.col("__of")))
        .dropDuplicates(["doc_id", "__hash"]).select("doc_id", "__hash", "text", "__toxic")
        .repartition(1).sortWithinPartitions("doc_id", "__hash")
    )
    # Fitted in a task: neither the texts nor what is worked out of them enters the driver.
    found = chosen_texts.mapInArrow(_fitted, "features binary, weights binary, bias double").first()
    if found is None:
        return fit(pa.array([], pa.string()), np.zeros(0))
    return Model(np.frombuffer(found["features"], U64), np.frombuffer(found["weights"], np.float64), found["bias"])


def _fitted(batches):
    """The model of all rows, which are one sample of bounded size."""
    held = [b.select(["text", "__toxic"]) for b in batches]
    empty = None if held else pa.schema([("text", pa.string()), ("__toxic", pa.int32())])
    table = pa.Table.from_batches(held, empty)
    model = fit(table.column("text").combine_chunks(), np.asarray(table.column("__toxic")))
    yield pa.RecordBatch.from_arrays(
        [pa.array([model.features.tobytes()], pa.binary()), pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.bias])],
        ["features", "weights", "bias"],
    )


def judge(docs: DataFrame, labels: DataFrame, **options) -> tuple[DataFrame, str]:
    """``docs`` with one more column (its name is returned) of ``FOUND``."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, **options))
    name = free_name(docs, "__toxicity")
    place = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, FOUND)])
    kind = pa.struct(
        [
            ("score", pa.float64()),
            ("sentences", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))),
        ]
    )

    def run(batches):
        for batch in batches:
            inner = pa.RecordBatch.from_arrays([batch.column(place)], ["text"])
            done = 0
            for part in parts(inner, "text", PART_BYTES):
                rows = batch.slice(done, part.num_rows)
                done += part.num_rows
                s = Sentences(part.column(0))
                logits = model.value.sentence_logits(s)
                score = noisy_or(logits, s.first)
                spans: dict[int, list] = {}
                # Code points before each byte of the part.
                points = np.r_[0, np.cumsum((s.words.buf & 0xC0) != 0x80)]
                for i in np.flatnonzero(logits >= np.log(OFFENDING / (1 - OFFENDING))).tolist():
                    t, (a, b) = int(s.text[i]), s.span(i)
                    before = int(points[s.offsets[t]])
                    spans.setdefault(t, []).append(
                        {"start": int(points[a]) - before, "end": int(points[b]) - before,
                         "score": float(1 / (1 + np.exp(-logits[i])))}
                    )
                found = [{"score": float(x), "sentences": spans.get(t, [])} for t, x in enumerate(score)]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(found, kind)], [f.name for f in schema.fields]
                )

    return docs.mapInArrow(run, schema), name


def scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row per document: held out or not, score, prediction, offending sentences."""
    out, name = judge(docs.select("doc_id", "text"), labels, **options)
    score = F.col(f"{name}.score")
    return out.select(
        "doc_id", held_out().alias("held_out"), score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"), F.col(f"{name}.sentences").alias("sentences"),
    )


def reject(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without those predicted toxic; same columns."""
    out, name = judge(docs, labels, **options)
    return out.filter(F.col(f"{name}.score") < 0.5).drop(name)
