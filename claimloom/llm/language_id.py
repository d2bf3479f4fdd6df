"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is lower-cased and read as UTF-8 bytes; runs of ASCII bytes that are no
letters are one space.  Subwords are the byte strings of a few lengths that do
not reach over a space, spaces at their ends included.  Each is hashed to an
embedding; the mean of a text's embeddings goes through a linear softmax.
Embeddings and weights are trained together by stochastic gradient descent in
numpy on pieces of a bounded sample of texts.  A temperature fitted on sampled
texts that were not trained on calibrates the probabilities; the same texts set
the confidence below which a prediction counts as rejected.

Since the softmax is linear, embeddings and weights are multiplied once after
training, and scoring adds up one row of this table per subword.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SIZES = (2, 3, 4)
BUCKETS, DIMENSIONS = 1 << 15, 12
EPOCHS, BATCH, RATE = 4, 32, 0.3
#: Bounds of what is learned from: characters of all texts together, of one text, and languages (the most frequent).
MAX_SAMPLE_CHARS, MAX_TEXT_CHARS, MAX_LANGUAGES = 2_000_000, 50_000, 64
#: Lengths in bytes of the pieces that texts are cut into for training, in turn.
PIECES = (24, 80, 250, 700)
#: Share of the sampled texts that calibrate, and the accuracy wanted of predictions that are not rejected.
CALIBRATING, WANTED = 5, 0.99
UNDETERMINED = "und"
#: Bytes that are scored at a time.
BLOCK = 1 << 18

_LETTERS = np.zeros(256, np.uint8)
for _b in range(256):
    _LETTERS[_b] = _b if _b >= 128 or chr(_b).isalpha() else 32
_TABLE = _LETTERS.tobytes()
_LONGEST = max(SIZES)


def normal(text: str | None) -> bytes:
    """Lower-case words with a space before, between and after."""
    return b" " + b" ".join((text or "").lower().encode("utf-8", "replace").translate(_TABLE).split()) + b" "


def subwords(data: np.ndarray, starts: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per subword length: which of the first ``starts`` places begin a subword, and the buckets of all of these places.

    A zero byte ends a text; no subword holds one.
    """
    out = []
    value = data.astype(np.uint32)
    inner = np.zeros(len(data), bool)  # a space that is neither the first nor the last byte, or the end of a text
    space, end = data == 32, data == 0
    for n in range(2, _LONGEST + 1):
        m = max(len(data) - n + 1, 0)
        if n > 2:
            inner = inner[:m] | space[n - 2 : n - 2 + m]
        inner = inner[:m] | end[:m] | end[n - 1 : n - 1 + m]
        value = value[:m] * np.uint32(0x01000193) + data[n - 1 : n - 1 + m]
        if n in SIZES:
            take = min(m, starts)
            mixed = (value[:take] ^ (value[:take] >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * n)
            out.append((~inner[:take], (mixed >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int32)))
    return out


@dataclass
class Model:
    """Languages and, per bucket, what a subword adds to the log-odds of each."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def logits(self, texts: Sequence[bytes]) -> np.ndarray:
        """One row per normalised text; each is read whole, in blocks of bounded size."""
        lengths = np.array([len(t) + 1 for t in texts], np.int64)
        ends = np.cumsum(lengths)
        data = np.frombuffer(b"\0".join([*texts, b""]), np.uint8)
        total, counts = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        for at in range(0, len(data), BLOCK):
            part = data[at : at + BLOCK + _LONGEST - 1]
            size = min(BLOCK, len(data) - at)
            added, number = np.zeros((size, len(self.languages)), np.float32), np.zeros(size, np.float32)
            for fits, bucket in subwords(part, size):
                where = np.flatnonzero(fits)
                added[where] += self.table[bucket[where]]
                number[where] += 1
            first, last = np.searchsorted(ends, [at, at + size - 1], "right")
            cuts = np.maximum(np.concatenate(([0], ends[first:last])) - at, 0)
            total[first : last + 1] += np.add.reduceat(added, cuts, axis=0, dtype=np.float64)
            counts[first : last + 1] += np.add.reduceat(number, cuts, dtype=np.float64)
        return total / np.maximum(counts, 1)[:, None] + self.bias

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        return _softmax(logits / self.temperature)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _pieces(text: bytes, longer: int) -> list[bytes]:
    """A text cut at spaces into pieces of changing lengths."""
    out, at = [], 0
    while at < len(text) - 1:
        end = text.find(b" ", min(at + PIECES[(len(out) + longer) % len(PIECES)], len(text) - 1))
        out.append(text[at : end + 1])
        at = end
    return out


def fit(texts: Sequence[str], languages: Sequence[str], seed: int = 13) -> Model:
    """Train on texts and their languages; a part of them, taken by turns within a language, only calibrates."""
    names = sorted(set(languages))
    if not names:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    seen: dict[str, int] = {}
    pieces, labels, held, held_labels = [], [], [], []
    for text, language in zip(texts, languages):
        turn = seen[language] = seen.get(language, 0) + 1
        own = _pieces(normal(text), turn)
        if turn % CALIBRATING == 0:
            # A piece as well as the whole, since short texts are the doubtful ones.
            own = [normal(text), own[0]]
            held += own
            held_labels += [names.index(language)] * len(own)
        else:
            pieces += own
            labels += [names.index(language)] * len(own)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    weights, bias = np.zeros((DIMENSIONS, len(names)), np.float32), np.zeros(len(names), np.float32)
    found = []
    for piece in pieces:
        data = np.frombuffer(piece, np.uint8)
        found.append(np.concatenate([bucket[fits] for fits, bucket in subwords(data, len(data))]))
    target = np.array(labels, np.int64)
    # Every language weighs alike, however many pieces it has.
    share = 1 / np.maximum(np.bincount(target, minlength=len(names)) * len(names) / max(len(target), 1), 1e-9)
    steps, step = EPOCHS * -(-len(pieces) // BATCH), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(pieces))
        for at in range(0, len(order), BATCH):
            chosen = [i for i in order[at : at + BATCH] if len(found[i])]
            if not chosen:
                continue
            rate = RATE * (1 - step / steps)
            step += 1
            sizes = np.array([len(found[i]) for i in chosen])
            buckets = np.concatenate([found[i] for i in chosen])
            cuts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            mean = np.add.reduceat(vectors[buckets], cuts, axis=0) / sizes[:, None]
            error = _softmax(mean @ weights + bias)
            error[np.arange(len(chosen)), target[chosen]] -= 1
            error *= np.minimum(share[target[chosen]], 10)[:, None]
            back = (error @ weights.T) / sizes[:, None]
            weights -= (rate * mean.T @ error).astype(np.float32)
            bias -= (rate * error.sum(axis=0)).astype(np.float32)
            np.subtract.at(vectors, buckets, np.repeat(rate * back, sizes, axis=0).astype(np.float32))
    model = Model(names, vectors @ weights, bias.astype(np.float64))
    return _calibrated(model, held, np.array(held_labels, np.int64))


def _calibrated(model: Model, texts: list[bytes], labels: np.ndarray) -> Model:
    """Temperature of the least log loss, and the lowest confidence from which on the accuracy is as wanted."""
    if not texts:
        return model
    logits = model.logits(texts)
    rows = np.arange(len(labels))

    def loss(temperature: float) -> float:
        return float(-np.log(np.maximum(_softmax(logits / temperature)[rows, labels], 1e-12)).mean())

    model.temperature = min((float(t) for t in np.geomspace(0.05, 20, 61)), key=loss)
    chance = model.probabilities(logits)
    sure, right = chance.max(axis=1), chance.argmax(axis=1) == labels
    order = np.argsort(-sure, kind="stable")
    accuracy = np.cumsum(right[order]) / (rows + 1)
    good = np.flatnonzero(accuracy >= WANTED)
    model.reject_below = float(sure[order[good[-1]]]) if len(good) else 1.0
    return model


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def held_out(doc_id: Column) -> Column:
    """Documents whose language is never learned from; a null id counts as the text ''."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(3)) == 1


def learn(docs: DataFrame, seed: int = 13, max_chars: int = MAX_SAMPLE_CHARS) -> Model:
    """Fit on documents (doc_id, text, lang), of which a bounded sample comes to the driver.

    Languages share ``max_chars`` characters alike; of a language with more,
    texts are taken by a hash.  Texts above MAX_TEXT_CHARS, without a letter or
    without a language are not learned from, nor languages beyond the
    MAX_LANGUAGES most frequent.  Without any text left nothing is learned.
    """
    fit_rows = docs.where(F.col("lang").isNotNull() & has_letter(F.col("text")) & (F.length("text") <= MAX_TEXT_CHARS))
    fit_rows = fit_rows.select(F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("doc_id", "text", F.lit(seed)).alias("h"))
    sizes = fit_rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))
    sizes = sizes.orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()
    if not sizes:
        return fit([], [], seed)
    each = max_chars / len(sizes)
    # A text is taken if its hash lies below the share of its language.
    limits = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], int(min(1.0, each / r["chars"]) * (1 << 30)))])
    chosen = fit_rows.where(F.pmod("h", F.lit(1 << 30)) < F.element_at(limits, F.col("lang")))
    sample = chosen.orderBy("lang", "h", "text").collect()
    return fit([r["text"] for r in sample], [r["lang"] for r in sample], seed)


def identify(docs: DataFrame, model: Model, keep: Sequence[str] = (), text: str = "text") -> DataFrame:
    """``keep`` columns, lang_pred, score and rejected of every row, from its whole text.

    ``lang_pred`` is the likeliest language and ``score`` its calibrated
    probability; a text that is null or has no letter, or any text if no
    language was learned, is ``und`` with score 0 and rejected.  ``rejected``
    says that the score lies below what the calibration wants; the language is
    given all the same.  Repeated rows are judged alike, an empty table gives
    none, other columns are dropped.
    """
    schema = T.StructType([docs.schema[c] for c in keep]).add("lang_pred", T.StringType()).add("score", T.DoubleType()).add("rejected", T.BooleanType())
    # At most one row of the table per bucket and language.
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        names = np.array([*model.languages, UNDETERMINED], object)
        for batch in batches:
            texts = batch.column(len(keep))
            known = batch.column(len(keep) + 1).to_numpy(zero_copy_only=False)
            language, score = np.full(batch.num_rows, len(model.languages)), np.zeros(batch.num_rows)
            at = 0
            while at < batch.num_rows:
                group, size = [], 0
                while at < batch.num_rows and size < 4 * BLOCK:
                    if known[at] and model.languages:
                        group.append((at, normal(texts[at].as_py())))
                        size += len(group[-1][1])
                    at += 1
                if group:
                    rows = [g[0] for g in group]
                    chance = model.probabilities(model.logits([g[1] for g in group]))
                    language[rows], score[rows] = chance.argmax(axis=1), chance.max(axis=1)
            rejected = (language == len(model.languages)) | (score < model.reject_below)
            made = [pa.array(names[language], pa.string()), pa.array(score), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *made], names=schema.names)

    return docs.select(*keep, F.col(text).alias("_source"), has_letter(F.col(text)).alias("_known")).mapInArrow(run, schema)
