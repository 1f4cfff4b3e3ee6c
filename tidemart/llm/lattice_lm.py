"""Language-model scoring: marginal likelihood of a text over all subword segmentations.

A word (lower-cased A-Z, between white space) is spelled by the pieces of an existing subword
vocabulary, of which every single byte is one; its first piece begins with the word mark.  The
pieces' weights start from the vocabulary's own scores and are re-estimated by EM on the words of
the training texts: a forward recursion in log space sums all segmentations of a word, a
backward one gives the expected use of each piece.  Every word type counts once, because the
lattice has to price what is rare.  A word of the training texts also has an arc of its own, by
absolute discounting; what the discounts free goes to the lattice.  This is done for each component
(the most frequent languages of the training texts); a document is a mixture over them, so its
score never reads its language:

    P(w | k) = (max(c_k(w) - d_k, 0) + (d_k * V_k + 1) * L(w)) / (N_k + 2)
    P(text)  = sum over k of pi_k * P(end | k) * product of P(w | k)

Pieces never cross words, so the recursion over a document factors into its words.

What is learned grows with the corpus and stays on Spark: words and their counts are tallied by
tasks, summed by a shuffle and written.  The driver holds the pieces' weights (size of the
vocabulary), totals per component and the ``TOP`` words of greatest count, which are broadcast (under
50 MB); occurrences of all other words are joined with the tallied words, one row per document and word.  A
word beyond the broadcast ones occurs at most (all words / TOP) times in the texts tallied.

Edge cases: NULL text is empty and has the end token alone; a NULL doc_id is a training text
(its crc32 counts as 0); NULL languages are one component; words of any length are scored whole;
repeated rows count and are scored each; without training texts counts are 0 and the vocabulary's
weights score alone; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .frames import materialise, read
from .words import row_of, scan, slices, whitespace_table

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
COMPONENTS = 8
TOP = 1 << 19
ROUNDS = 3
ALPHA = 0.1          # added to the expected use of every piece
FLUSH = 1 << 17      # tallied words a task holds before it merges them
SLICE = 2 << 20      # bytes of text scanned at once, one text at least
LATTICE = 1 << 18    # bytes of words in one lattice pass, one word at least
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0x100000001B3)


class Pieces(NamedTuple):
    """Byte strings of a vocabulary by rolling hash, and log weights that sum to one."""

    hash: np.ndarray     # uint64, ascending
    filter: np.ndarray   # 2**20 flags of whole pieces
    begins: np.ndarray   # 2**20 flags of their beginnings
    longest: int
    logp: np.ndarray     # natural logarithms, in the order of ``hash``


class Model(NamedTuple):
    words: DataFrame     # word, total, c0 ... of every tallied word
    pieces: Pieces
    tokens: np.ndarray   # per component: training tokens with ends,
    types: np.ndarray    # training words,
    discount: np.ndarray
    docs: np.ndarray     # training texts
    known: int           # distinct training tokens, the end included
    top: tuple           # word hash (ascending), base log10, known flag, log10 P(w | k) of the broadcast words


def vocabulary(path: str = VOCABULARY) -> tuple[list[bytes], np.ndarray]:
    """(byte strings, log weights) of a sentencepiece model; the word mark is a space, bytes not listed are added.

    Scores of a merge list (whole numbers from 0 down) are ranks and weigh 1 / (rank + 1); others are
    log weights.
    """
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    scores: dict[bytes, float] = {}
    for i in range(model.vocab_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i).replace("▁", " ").encode()
        if piece and b" " not in piece[1:]:
            scores.setdefault(piece, model.get_score(i))
    values = np.array(list(scores.values()))
    ranks = bool(len(values)) and bool((values == np.round(values)).all() and (values <= 0).all())
    weight = -np.log1p(-values) if ranks else values
    names = list(scores)
    least = float(weight.min()) if len(weight) else 0.0
    missing = [bytes([b]) for b in range(256) if bytes([b]) not in scores]
    return names + missing, np.concatenate([weight, np.full(len(missing), least)])


def _rolled(name: bytes) -> list[np.uint64]:
    h, out = np.uint64(0), []
    with np.errstate(over="ignore"):
        for b in name:
            h = (h + np.uint64(b + 1)) * _STEP
            out.append(h)
    return out


def _flag(h):
    return (h * _MIX) >> np.uint64(44)


def pieces_of(names: list[bytes], logw: np.ndarray) -> Pieces:
    steps = [_rolled(x) for x in names]
    last = np.array([x[-1] for x in steps], np.uint64)
    order = np.argsort(last)
    whole, begins = np.zeros(1 << 20, bool), np.zeros(1 << 20, bool)
    whole[_flag(last)] = True
    begins[_flag(np.array([h for x in steps for h in x], np.uint64))] = True
    logw = np.asarray(logw, float)[order]
    top = logw.max()
    return Pieces(last[order], whole, begins, max(len(x) for x in names), logw - top - np.log(np.exp(logw - top).sum()))


class Lattice(NamedTuple):
    """All pieces found in a run of words: nodes are places between bytes, arcs are pieces."""

    first: np.ndarray   # node before the first byte of each word; its last node is the next one's first - 1
    start: np.ndarray   # node of each arc's start
    size: np.ndarray
    piece: np.ndarray
    local: np.ndarray   # bytes of the word before the arc
    nodes: int


def lattice(data: np.ndarray, offsets: np.ndarray, pieces: Pieces) -> Lattice:
    """Lattice of words that lie end to end in ``data``, each beginning with the word mark."""
    size = np.diff(offsets)
    word = np.repeat(np.arange(len(size)), size)
    left = np.repeat(offsets[1:], size) - np.arange(len(data))
    at, h = np.arange(len(data)), np.zeros(len(data), np.uint64)
    found = []
    for k in range(1, pieces.longest + 1):
        live = left[at] >= k
        at, h = at[live], h[live]
        if not len(at):
            break
        h = (h + (data[at + k - 1].astype(np.uint64) + np.uint64(1))) * _STEP
        flags = _flag(h)
        hit = np.flatnonzero(pieces.filter[flags])
        place = np.minimum(np.searchsorted(pieces.hash, h[hit]), len(pieces.hash) - 1)
        same = pieces.hash[place] == h[hit]
        found.append((at[hit[same]], np.full(int(same.sum()), k), place[same]))
        go = pieces.begins[flags]
        at, h = at[go], h[go]
    start, long, piece = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    return Lattice(offsets[:-1] + np.arange(len(size)), start + word[start], long, piece,
                   start - offsets[word[start]], len(data) + len(size))


def _waves(key: np.ndarray, size: np.ndarray):
    """Arcs by ``key``, those of one size at a time: arcs of a wave have no end (and no start) in common."""
    both = key * (int(size.max()) + 1 if len(size) else 1) + size
    order = np.argsort(both, kind="stable")
    cuts = np.flatnonzero(np.diff(both[order])) + 1
    return np.split(order, cuts) if len(order) else []


def forward(x: Lattice, logp: np.ndarray) -> np.ndarray:
    """Log of the summed weights of all ways from a word's first node to every node."""
    a = np.full(x.nodes, -np.inf)
    a[x.first] = 0.0
    for w in _waves(x.local + x.size, x.size):
        end = x.start[w] + x.size[w]
        a[end] = np.logaddexp(a[end], a[x.start[w]] + logp[x.piece[w]])
    return a


def backward(x: Lattice, logp: np.ndarray, last: np.ndarray) -> np.ndarray:
    b = np.full(x.nodes, -np.inf)
    b[last] = 0.0
    for w in _waves(x.local, x.size)[::-1]:
        start = x.start[w]
        b[start] = np.logaddexp(b[start], b[start + x.size[w]] + logp[x.piece[w]])
    return b


def _marked(words: pa.Array):
    """Runs of words as (bytes with the word mark before each word, offsets)."""
    words = words.cast(pa.large_binary())
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset: words.offset + len(words) + 1]
    raw = np.frombuffer(words.buffers()[2], np.uint8) if words.buffers()[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(words):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + LATTICE, side="right")) - 1)
        out = offsets[lo: hi + 1] - offsets[lo] + np.arange(hi - lo + 1)
        data = np.full(int(out[-1]), 32, np.uint8)
        keep = np.ones(len(data), bool)
        keep[out[:-1]] = False
        data[keep] = raw[offsets[lo]: offsets[hi]]
        yield data, out
        lo = hi


def log10_marginals(words: pa.Array, pieces: Pieces) -> np.ndarray:
    """log10 of the summed weights of all segmentations of each word."""
    out = [np.zeros(0)]
    for data, offsets in _marked(words):
        x = lattice(data, offsets, pieces)
        out.append(forward(x, pieces.logp)[x.first + np.diff(offsets)] / np.log(10))
    return np.concatenate(out)


def _expected(shared):
    """Task function: expected use of each piece in the words of its batches, each word once."""
    def run(batches):
        pieces = Pieces(*shared.value)
        use = np.zeros(len(pieces.hash))
        for batch in batches:
            for data, offsets in _marked(batch.column("word")):
                x = lattice(data, offsets, pieces)
                last = x.first + np.diff(offsets)
                a, b = forward(x, pieces.logp), backward(x, pieces.logp, last)
                total = np.repeat(a[last], np.diff(offsets) + 1)  # of a node's word
                arc = np.exp(a[x.start] + pieces.logp[x.piece] + b[x.start + x.size] - total[x.start])
                use += np.bincount(x.piece, arc, len(use))
        at = np.flatnonzero(use)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(use[at])], names=["piece", "used"])
    return run


def learn_pieces(words: DataFrame, pieces: Pieces, rounds: int = ROUNDS) -> Pieces:
    """Weights of the pieces by ``rounds`` of EM over the distinct words of ``words`` (column word)."""
    spark = words.sparkSession
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(tuple(pieces))
        # at most one row per piece comes back
        rows = (words.select("word").mapInArrow(_expected(shared), "piece int, used double")
                .groupBy("piece").agg(F.sum("used").alias("used")).toArrow())
        shared.destroy()
        use = np.full(len(pieces.hash), ALPHA)
        use[rows.column("piece").to_numpy()] += rows.column("used").to_numpy()
        pieces = pieces._replace(logp=np.log(use) - np.log(use.sum()))
    return pieces


def _gather(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte ranges as an Arrow binary array."""
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    at = np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[at]))])


def _tally(k: int):
    """Task function: words of (component, text) rows with their occurrences in all and per component."""
    names = ["word", "total", *(f"c{i}" for i in range(k))]

    def merged(tables):
        both = pa.concat_tables(tables).group_by("word", use_threads=False).aggregate([(n, "sum") for n in names[1:]])
        return both.select(["word", *(f"{n}_sum" for n in names[1:])]).rename_columns(names)

    def out(table):
        return table.set_column(0, "word", table.column("word").cast(pa.binary())).combine_chunks().to_batches()

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                words = scan(part.column("text"), whitespace_table(), lower=True)
                if not len(words.hash):
                    continue
                _, first, which = np.unique(words.hash, return_index=True, return_inverse=True)
                of = np.asarray(part.column("component"))[row_of(words, np.arange(len(which)))]
                columns = [_gather(words.data, words.start[first], words.end[first]), np.bincount(which, minlength=len(first))]
                columns += [np.bincount(which[of == i], minlength=len(first)) for i in range(k)]
                held.append(pa.table([columns[0], *(pa.array(x, pa.int64()) for x in columns[1:])], names=names))
                rows += len(first)
                if rows > FLUSH and len(held) > 1:
                    held = [merged(held)]
                    rows = held[0].num_rows
                    if rows > FLUSH // 2:
                        yield from out(held.pop())
                        rows = 0
                        pa.default_memory_pool().release_unused()
        if held:
            yield from out(merged(held))
    return run


def fit(docs: DataFrame, training: Column, text: str = "text", component: str = "lang", path: str = VOCABULARY,
        components: int = COMPONENTS, rounds: int = ROUNDS, top: int = TOP) -> Model:
    """Model of the ``training`` rows of ``docs``; the other rows' words are tallied without a count."""
    given = docs.select(F.coalesce(training, F.lit(False)).alias("training"),
                        F.coalesce(F.col(component).cast("string"), F.lit("")).alias("component"), F.col(text).alias("text"))
    sizes = given.filter("training").groupBy("component").count().orderBy(F.desc("count"), "component")
    head = sizes.limit(components + 1).collect()
    named = [r["component"] for r in head[: components if len(head) <= components else components - 1]]
    k = max(1, min(len(head), components))
    number = F.lit(k - 1)
    for i, name in enumerate(named):
        number = F.when(F.col("component") == name, i).otherwise(number)
    numbered = given.select(F.when(F.col("training"), number).otherwise(-1).alias("component"), "text")
    counts = [f"c{i}" for i in range(k)]
    words = materialise(
        numbered.mapInArrow(_tally(k), "word binary, total long, " + ", ".join(f"{c} long" for c in counts))
        .groupBy("word").agg(*(F.sum(c).alias(c) for c in ["total", *counts])))
    texts = {r["component"]: r["count"] for r in numbered.groupBy("component").count().collect()}  # k + 1 rows
    ends = np.array([texts.get(i, 0) for i in range(k)], float)

    def number_of(condition):
        return F.coalesce(F.sum(F.when(condition, 1)), F.lit(0))
    of_all = sum((F.col(c) for c in counts[1:]), F.col("c0"))
    r = words.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(f"n_{c}") for c in counts),
                  *(number_of(F.col(c) > 0).alias(f"v_{c}") for c in counts),
                  *(number_of(F.col(c) == m).alias(f"{m}_{c}") for c in counts for m in (1, 2)),
                  number_of(of_all > 0).alias("known"),
                  *(number_of(F.col("total") >= (1 << j)).alias(f"over_{j}") for j in range(63))).first()
    tokens = np.array([r[f"n_{c}"] for c in counts], float) + ends
    once, twice = (np.array([r[f"{m}_{c}"] for c in counts], float) for m in (1, 2))
    discount = np.where(once > 0, once / np.maximum(once + 2 * twice, 1), 0.5)
    pieces = learn_pieces(words.filter(of_all > 0), pieces_of(*vocabulary(path)), rounds)
    model = Model(words, pieces, tokens, np.array([r[f"v_{c}"] for c in counts], float), discount, ends,
                  r["known"] + int(ends.sum() > 0), ())
    least = min(j for j in range(63) if r[f"over_{j}"] <= top or j == 62)
    # at most ``top`` words
    often = words.filter(F.col("total") >= (1 << least)).toArrow()
    names = often.column("word").combine_chunks().cast(pa.binary())
    c = np.stack([often.column(x).to_numpy() for x in counts]).astype(float)
    hashes = scan(names, whitespace_table(), lower=False).hash
    order = np.argsort(hashes)
    per = _log10_words(model, c, log10_marginals(names, pieces))
    return model._replace(top=(hashes[order], _log10_base(model, c.sum(0))[order], (c.sum(0) > 0)[order],
                               np.ascontiguousarray(per[:, order])))


def _log10_base(m: Model, c):
    return np.log10((c + 0.5) / (m.tokens.sum() + 0.5 * (m.known + 1)))


def _log10_words(m: Model, c: np.ndarray, marginal: np.ndarray) -> np.ndarray:
    """log10 P(w | k), a row per component, from the counts (a row per component) and log10 L(w)."""
    free = (m.discount * m.types + 1)[:, None]
    own = np.maximum(c - m.discount[:, None], 0)
    with np.errstate(divide="ignore"):
        return np.logaddexp(np.log(own), np.log(free) + marginal[None, :] * np.log(10)) / np.log(10) - np.log10(m.tokens + 2)[:, None]


def _score(shared, k: int):
    """Task function: sums over the broadcast words of each text, and its other words with their marginals."""
    def run(batches):
        pieces, (hashes, base, known, per) = Pieces(*shared.value[0]), shared.value[1]
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                words = scan(part.column("text"), whitespace_table(), lower=True)
                rows = part.num_rows
                of = row_of(words, np.arange(len(words.hash)))
                at = np.minimum(np.searchsorted(hashes, words.hash), max(len(hashes) - 1, 0))
                has = hashes[at] == words.hash if len(hashes) else np.zeros(len(of), bool)
                inside, at = of[has], at[has]
                sums = [np.bincount(inside, per[i][at], rows).astype(float) for i in range(k)]
                rare = np.flatnonzero(~has)
                _, first, which = np.unique(words.hash[rare], return_index=True, return_inverse=True)
                names = _gather(words.data, words.start[rare[first]], words.end[rare[first]])
                marginal = log10_marginals(names, pieces)
                pair, n = np.unique(of[rare] * max(len(first), 1) + which, return_counts=True)
                row, word = np.divmod(pair, max(len(first), 1))
                cuts = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
                others = pa.StructArray.from_arrays(
                    [names.take(pa.array(word)).cast(pa.binary()), pa.array(n, pa.int64()), pa.array(marginal[word])],
                    names=["word", "n", "marginal"])
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc_id"), pa.array(words.counts, pa.int64()),
                     pa.array(np.bincount(inside, known[at], rows).astype(np.int64)), pa.array(np.bincount(inside, base[at], rows).astype(float)),
                     pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * k), pa.array(np.stack(sums, 1).reshape(-1))),
                     pa.ListArray.from_arrays(pa.array(cuts), others)],
                    names=["row", "doc_id", "n_words", "n_known", "base", "sums", "others"])
    return run


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark, k = docs.sparkSession, len(model.docs)
    shared = spark.sparkContext.broadcast((tuple(model.pieces), model.top))
    given = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    found = materialise(given.mapInArrow(
        _score(shared, k), f"row long, doc_id {kind}, n_words long, n_known long, base double, sums array<double>, "
                           "others array<struct<word: binary, n: bigint, marginal: double>>"))
    shared.destroy()
    others = (found.select("row", F.explode("others").alias("x")).select("row", "x.*")
              .join(model.words.drop("total"), "word", "left"))
    counts = [F.coalesce(F.col(f"c{i}"), F.lit(0)) for i in range(k)]
    of_all = sum(counts[1:], counts[0])
    per = []
    for i in range(k):
        free = float(np.log10(model.discount[i] * model.types[i] + 1))
        spelled = F.col("marginal") + F.lit(free)
        value = F.when(counts[i] > 0, F.log10(counts[i] - F.lit(float(model.discount[i])) + F.pow(F.lit(10.0), spelled))).otherwise(spelled)
        per.append(F.sum(F.col("n") * (value - F.lit(float(np.log10(model.tokens[i] + 2))))).alias(f"s{i}"))
    rest = float(model.tokens.sum() + 0.5 * (model.known + 1))
    others = others.groupBy("row").agg(
        F.sum(F.when(of_all > 0, F.col("n")).otherwise(0)).alias("known"),
        F.sum(F.col("n") * F.log10((of_all + F.lit(0.5)) / F.lit(rest))).alias("more"), *per)
    # a text's own sums, the end token and the logarithm of its component's share
    docs_all = max(1.0, float(model.docs.sum()))
    logs = [F.col("sums")[i] + F.coalesce(f"s{i}", F.lit(0.0))
            + F.lit(float(np.log10((model.docs[i] + 1) / (model.tokens[i] + 2)) + np.log10(max(model.docs[i] / docs_all, 1e-300))))
            for i in range(k)]
    best = F.greatest(*logs) if k > 1 else logs[0]
    summed = sum((F.pow(F.lit(10.0), x - F.col("best")) for x in logs[1:]), F.pow(F.lit(10.0), logs[0] - F.col("best")))
    end = float(_log10_base(model, model.docs.sum()))
    return (found.drop("others").join(others, "row", "left").withColumn("best", best)
            .select("doc_id", (F.col("n_words") + 1).alias("n_tokens"),
                    (F.col("n_known") + F.coalesce("known", F.lit(0)) + F.lit(int(model.docs.sum() > 0))).alias("n_known"),
                    F.lit(int(model.tokens.sum())).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("more", F.lit(0.0)) + F.lit(end)).alias("base_score"),
                    (F.col("best") + F.log10(summed)).alias("score")))


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32(doc_id as text) mod 5 is 1; false for NULL."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 1, F.lit(False))


def query(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, ~held_out()))
    return scored.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
