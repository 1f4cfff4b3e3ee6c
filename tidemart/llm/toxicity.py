"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its distinct words, word pairs and pairs with one or two words
between them, hashed to ``2**BITS`` slots; nothing but the text enters a score.  Training
runs on a sample of labelled rows: in the order of a hash of the id the first ``MAX_TRAIN``,
and of these each whose distinct slots still fit in ``MAX_SLOTS`` (4 bytes each on the
driver).  Per-coordinate learning rates and L1 sparsity leave a few thousand weights, which
are broadcast.  Scoring is one narrow pass over whole texts.

Edge cases: NULL and empty texts get the score of the intercept; without any labelled row
the intercept is the prior ``PRIOR``; rows whose label is NULL are not learned from, and of
several labels of one id the largest counts; a NULL id is not held out and never learned
from; repeated rows are scored each, and of several texts of one id the sample has one; labels
without a document take their place of the ``MAX_TRAIN``; extra columns are ignored or passed through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidemart.sources.scratch import lifetime

from .frames import materialise, read
from .words import alnum_table, mix, released, scan, slices

BITS = 22
SKIPS = (1, 2, 3)      # distance between the two words of a pair
MAX_TRAIN = 8000       # labelled texts learned from, at most
MAX_SLOTS = 1 << 25    # distinct slots of all of them, at most
SLICE = 1 << 20        # bytes of text whose features a task holds at a time
EPOCHS = 6
ALPHA, BETA, L1, L2 = 3.0, 1.0, 6.0, 1.0
PRIOR = 0.05
THRESHOLD = 0.3
SEED = 20


def features(column) -> tuple[np.ndarray, np.ndarray, int]:
    """(row, slot) of every n-gram and skip-gram of a text column, and the number of rows."""
    words = scan(pc.utf8_lower(column.cast(pa.large_string())), alnum_table(), lower=False)
    shift = np.uint64(64 - BITS)
    owner = np.repeat(np.arange(len(words.first) - 1), words.counts)
    rows, slots = [owner], [words.hash >> shift]
    for gap in SKIPS:
        if len(words.hash) > gap:
            same = owner[gap:] == owner[:-gap]
            pair = mix(words.hash[:-gap] * np.uint64(2 * gap + 1) ^ np.roll(words.hash, -gap)[:-gap] + np.uint64(gap))
            rows.append(owner[gap:][same])
            slots.append(pair[same] >> shift)
    return np.concatenate(rows), np.concatenate(slots).astype(np.int64), len(words.first) - 1


@released
def _collect_features(batches):
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            rows, slots, n = features(part.column("text"))
            key = np.unique(rows << BITS | slots)
            bounds = np.searchsorted(key >> BITS, np.arange(n + 1))
            slot = (key & ((1 << BITS) - 1)).astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("y"),
                 pa.array([slot[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())],
                names=["doc_id", "y", "slots"])


def train(samples: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray, float]:
    """FTRL-proximal over (distinct slots of a text, label): non-zero slots, their weights, intercept."""
    prior = (labels.sum() + PRIOR) / (len(labels) + 1)
    base = float(np.log(prior / (1 - prior)))
    if not len(labels):
        return np.zeros(0, np.int64), np.zeros(0, np.float32), base
    count = np.zeros(1 << BITS, np.int32)
    for s in samples:
        count[s] += 1
    used = np.flatnonzero(count > 1)  # a slot of one text only says nothing about others
    place = np.full(1 << BITS, -1, np.int32)
    place[used] = np.arange(len(used))
    # one array for all texts: thousands of small ones would leave the driver's heap in pieces
    flat, ends = np.empty(sum(map(len, samples)), np.int32), np.zeros(len(samples) + 1, np.int64)
    for i, s in enumerate(samples):
        at = place[s]
        at = at[at >= 0]
        ends[i + 1] = ends[i] + len(at)
        flat[ends[i]: ends[i + 1]] = at
    del count, place
    z, n = np.zeros(len(used)), np.zeros(len(used))
    bias = [0.0, 0.0]
    rng = np.random.default_rng(SEED)

    def weights(zi, ni):
        return np.where(np.abs(zi) > L1, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2), 0.0)

    for _ in range(epochs):
        for i in rng.permutation(len(samples)):
            at = flat[ends[i]: ends[i + 1]]
            w = weights(z[at], n[at])
            b = -bias[0] / ((BETA + bias[1] ** 0.5) / ALPHA)
            p = 1 / (1 + np.exp(-np.clip(w.sum() + b + base, -35, 35)))
            g = p - labels[i]
            grown = np.sqrt(n[at] + g * g)
            z[at] += g - (grown - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
            bias[0] += g - ((bias[1] + g * g) ** 0.5 - bias[1] ** 0.5) / ALPHA * b
            bias[1] += g * g
    w = weights(z, n)
    keep = np.flatnonzero(w)
    return (used[keep].astype(np.int64), w[keep].astype(np.float32),
            base - bias[0] / ((BETA + bias[1] ** 0.5) / ALPHA))


def scores(column, slots: np.ndarray, weights: np.ndarray, bias: float, table: np.ndarray | None = None) -> np.ndarray:
    """Probability of the toxic label for each text of a column."""
    if table is None:
        table = weight_table(slots, weights)
    rows, found, n = features(column)
    w = table[found]
    at = np.flatnonzero(w)
    key = np.unique(rows[at] << BITS | found[at])
    total = np.bincount(key >> BITS, table[key & ((1 << BITS) - 1)], n) + bias
    return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def weight_table(slots: np.ndarray, weights: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << BITS, np.float32)
    table[slots] = weights
    return table


def _fitting(sizes: pa.Table, most: int) -> list[int]:
    """Ids of the texts that fit, one after the other in the order of ``place``, in ``most`` slots."""
    out, left = [], most
    for doc_id, n in zip(*(sizes.sort_by([("place", "ascending"), ("doc_id", "ascending")]).column(c).to_pylist()
                           for c in ("doc_id", "n"))):
        if n <= left:
            out.append(doc_id)
            left -= n
    return out


def sample(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, max_slots: int = MAX_SLOTS, doc_id: str = "doc_id",
           text: str = "text", label: str = "toxic") -> DataFrame:
    """(doc_id, y, slots) of the texts to learn from, none of them held out; slots are packed as uint32."""
    known = (labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
             .filter("doc_id IS NOT NULL AND y IS NOT NULL").filter(~held_out("doc_id"))
             .groupBy("doc_id").agg(F.max("y").alias("y")).withColumn("place", F.xxhash64("doc_id")))
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    picked = known.orderBy("place", "doc_id").limit(max_train)  # rows of 20 bytes
    # features are made by the tasks that read the texts
    found = materialise(texts.join(F.broadcast(picked), "doc_id").select("doc_id", "y", "text")
                        .mapInArrow(_collect_features, "doc_id long, y int, slots binary")
                        .groupBy("doc_id", "y").agg(F.min("slots").alias("slots")))
    sizes = found.select("doc_id", F.xxhash64("doc_id").alias("place"), (F.octet_length("slots") / 4).cast("long").alias("n")).toArrow()
    taken = _fitting(sizes, max_slots)
    if len(taken) == sizes.num_rows:
        return found
    ids = docs.sparkSession.createDataFrame([(i,) for i in taken], "doc_id long")
    return found.join(F.broadcast(ids), "doc_id", "left_semi")


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, doc_id: str = "doc_id", text: str = "text",
        label: str = "toxic", max_slots: int = MAX_SLOTS) -> tuple[np.ndarray, np.ndarray, float]:
    """Train on the labelled texts of ``sample``, which are all outside the held-out rows."""
    with lifetime(docs.sparkSession):
        table = sample(docs, labels, max_train, max_slots, doc_id, text, label).toArrow()
    order = np.argsort(table.column("doc_id").to_numpy(), kind="stable")  # of the ids; the slots are not copied
    slots, y = table.column("slots"), table.column("y").to_numpy().astype(float)
    samples = [np.frombuffer(x.as_buffer(), np.uint32) for x in slots]
    model = train([samples[i] for i in order], y[order])
    del samples, slots, table
    pa.default_memory_pool().release_unused()  # the driver goes on without the sample
    return model


def held_out(doc_id) -> "F.Column":
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def _score(shared, text: str):
    def run(batches):
        slots, weights, bias = shared.value
        table = weight_table(slots, weights)
        for batch in batches:
            for part in slices(batch, text, SLICE):
                yield part, scores(part.column(text), slots, weights, bias, table)
    return run


def _with_scores(shared, threshold: float):
    @released
    def run(batches):
        for part, score in _score(shared, "text")(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(score, pa.float64()),
                 pa.array((score >= threshold).astype(np.int32), pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"])
    return run


def _kept(shared, text: str, threshold: float):
    @released
    def run(batches):
        for part, score in _score(shared, text)(batches):
            yield part.filter(pa.array(score < threshold))
    return run


def score(docs: DataFrame, model, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and prediction of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
            .select("doc_id", held_out("doc_id").alias("held_out"), "text")
            .mapInArrow(_with_scores(shared, threshold), "doc_id long, held_out boolean, score double, predicted int"))


def remove(docs: DataFrame, model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score stays under ``threshold``, unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_kept(shared, text, threshold), docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return score(docs, fit(docs, read(spark, sf_dir, "labels")))
