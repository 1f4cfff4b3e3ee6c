"""Substring dedup: repeated runs of words found as compacted paths of a de Bruijn graph.

Every run of ``k`` consecutive words (white space apart) of one document is an edge.  An
edge is removed, with the words it covers, where the same word sequence starts earlier: in
a document of smaller id, or earlier in the same one.

1. Anchors.  Each edge is represented by the smallest hash among its runs of ``k / 2``
   words (equal edges have equal anchors at equal places).  Only anchors that occur more than once
   in the corpus can belong to repeated edges; the others go no further.
2. Edges of the remaining anchors meet by anchor.  The first coordinate (document, word)
   of each distinct edge is its source; all other occurrences point to theirs.
3. Occurrences whose own and source coordinates both advance by one are a nonbranching
   path; paths compact inside a task and then, joined by document, across tasks.
4. Spark joins fetch the words at both coordinates of every path, and a path counts only if
   their digests agree.

Hot edges (boilerplate, large groups of copies) are settled inside each task first, so one
row per edge and task is shuffled.

Edge cases: NULL or empty text has no words; texts under ``k`` words stay whole; rows that
repeat both id and text are one document and get the same result each; different texts under
one id are separate documents in the order of a text hash; a NULL id comes before all
others; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .frames import materialise, read, shuffle_partitions
from .repeats import LOCAL_SCHEMA, local_rows, repeated, signed
from .words import Words, mix, row_of, scan, slices, whitespace_table, windows

K = 20
MAX_IDS = 2_000_000      # ids of candidate documents that may be broadcast (16 bytes each)
REQUESTS = 10_000        # coordinates looked up in one copy of a source text
_NO_ID = -(1 << 63)
_PIECE = [("doc", pa.int64()), ("tie", pa.int64()), ("pos", pa.int32()), ("n", pa.int32()),
          ("sdoc", pa.int64()), ("stie", pa.int64()), ("spos", pa.int32())]
PIECE_SCHEMA = "doc long, tie long, pos int, n int, sdoc long, stie long, spos int"


def _anchor_of(words: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, anchor word, anchor hash) of every edge of the batch."""
    half = max(1, k // 2)
    g, at = windows(words, half)
    full = np.full(len(words.hash), np.iinfo(np.uint64).max, np.uint64)
    full[at] = g
    _, start = windows(words, k)
    best, place = full[start], start.copy()
    for j in range(1, k - half + 1):
        other = full[start + j]
        better = other < best
        best[better] = other[better]
        place[better] += j - (place[better] - start[better])
    return start, place, best


def _anchors(k: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                words = scan(part.column("text"), whitespace_table(), lower=False)
                _, place, h = _anchor_of(words, k)
                place, first = np.unique(place, return_index=True)
                yield local_rows(h[first], row_of(words, place), np.asarray(part.column("doc")),
                                 np.asarray(part.column("tie")), twice=True)
    return run


def _whole(batches):
    """doc, tie, word count and digest of all words of each text."""
    for batch in batches:
        for part in slices(batch, "text"):
            words = scan(part.column("text"), whitespace_table(), lower=False)
            keep = np.ones(len(words.hash), bool)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), part.column("tie"), pa.array(words.counts, pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in _joined(words, keep)], pa.string())],
                names=["doc", "tie", "n_words", "sha"])


def _joined(words: Words, keep: np.ndarray):
    """Bytes of the kept words of each row, joined by one space."""
    raw = words.data.tobytes()
    for a, b in zip(words.first[:-1], words.first[1:]):
        at = np.flatnonzero(keep[a:b]) + a
        yield b" ".join([raw[s:e] for s, e in zip(words.start[at].tolist(), words.end[at].tolist())])


def _compact(doc, tie, pos, n, sdoc, stie, spos) -> list[np.ndarray]:
    """Paths: pieces whose own and source coordinates go on where the piece before ended.

    Pieces (n edges from pos on) may overlap in edges; the result covers the same edges.
    """
    order = np.lexsort((pos, tie, doc))
    doc, tie, pos, n, sdoc, stie, spos = (x[order] for x in (doc, tie, pos, n, sdoc, stie, spos))
    if not len(doc):
        return [doc, tie, pos, n, sdoc, stie, spos]
    cut = np.ones(len(doc), bool)
    cut[1:] = (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (pos[1:] != pos[:-1] + n[:-1]) \
        | (sdoc[1:] != sdoc[:-1]) | (stie[1:] != stie[:-1]) | (spos[1:] != spos[:-1] + n[:-1])
    at = np.flatnonzero(cut)
    return [doc[at], tie[at], pos[at], np.add.reduceat(n, at).astype(np.int32), sdoc[at], stie[at], spos[at]]


def _piece_batches(pieces: list[np.ndarray], extra: dict):
    arrays = [pa.array(x) for x in pieces]
    names = [x for x, _ in _PIECE]
    kinds = dict(_PIECE)
    arrays = [a.cast(kinds[x]) for a, x in zip(arrays, names)]
    size = len(arrays[0])
    return pa.RecordBatch.from_arrays(
        arrays + [pa.nulls(size, kind) if fill is None else pa.array([fill] * size, kind)
                  for kind, fill in extra.values()], names=names + list(extra))


def _edges(k: int):
    """Task function over (doc, tie, text, anchors): runs of edges by anchor, and settled pieces.

    A run has the keys (64 bits) and checks (32 bits) of consecutive edges with one anchor.
    Edges that repeat inside the batch leave as pieces (tag 2) that point to the first one.
    """
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                yield _edge_batch(part, k)
    return run


def _edge_batch(part: pa.RecordBatch, k: int) -> pa.RecordBatch:
    words = scan(part.column("text"), whitespace_table(), lower=False)
    start, place, anchor = _anchor_of(words, k)
    row = row_of(words, start)
    known = part.column("anchors")
    flat, bounds = np.asarray(known.flatten()).view(np.uint64), np.concatenate(
        [[0], np.cumsum(np.asarray(pc.list_value_length(known)))])
    wanted = np.zeros(len(start), bool)
    edge = np.searchsorted(row, np.arange(part.num_rows + 1))
    for i in range(part.num_rows):
        a, b = edge[i], edge[i + 1]
        wanted[a:b] = np.isin(anchor[a:b], flat[bounds[i]: bounds[i + 1]])
    doc, tie = np.asarray(part.column("doc")), np.asarray(part.column("tie"))
    key = windows(words, k)[0][wanted]
    check = (windows(words, k, salt=7)[0][wanted] >> np.uint64(32)).astype(np.uint32)
    start, place, anchor, row = (x[wanted] for x in (start, place, anchor, row))
    pos = start - words.first[row]
    d, t = doc[row], tie[row]
    order = np.lexsort((pos, t, d, check, key))
    head = np.ones(len(order), bool)
    head[1:] = (key[order][1:] != key[order][:-1]) | (check[order][1:] != check[order][:-1])
    source = order[np.flatnonzero(head)[np.cumsum(head) - 1]] if len(order) else order
    later = order[~head]
    src = source[~head]
    # rows that repeat an id and a text are one document: no piece points to itself
    real = (d[later] != d[src]) | (t[later] != t[src]) | (pos[later] != pos[src])
    later, src = later[real], src[real]
    pieces = _compact(d[later], t[later], pos[later], np.ones(len(later), np.int32), d[src], t[src], pos[src])
    at = np.sort(order[head])  # global edges, in the order of the batch
    cut = np.ones(len(at), bool)
    cut[1:] = (start[at][1:] != start[at][:-1] + 1) | (place[at][1:] != place[at][:-1])
    first = np.flatnonzero(cut)
    many = np.diff(np.concatenate([first, [len(at)]]))
    offsets = np.concatenate([[0], np.cumsum(many)])
    lead = at[first]

    def blobs(values):
        size = values.dtype.itemsize
        return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((offsets * size).astype(np.int32).tobytes()),
                                                               pa.py_buffer(values.tobytes())])
    n = len(pieces[0])
    none = pa.nulls(n, pa.binary())
    columns = {
        "k": (signed(anchor[lead]), signed(mix(pieces[0].view(np.uint64)))),
        "doc": (d[lead], pieces[0]), "tie": (t[lead], pieces[1]), "pos": (pos[lead], pieces[2]),
        "n": (many, pieces[3]), "sdoc": (np.zeros(len(lead), np.int64), pieces[4]),
        "stie": (np.zeros(len(lead), np.int64), pieces[5]), "spos": (np.zeros(len(lead), np.int32), pieces[6]),
        "tag": (np.zeros(len(lead), np.int32), np.full(n, 2, np.int32))}
    kinds = {"k": pa.int64(), "tag": pa.int32()} | dict(_PIECE)
    arrays = [pa.array(np.concatenate(v)).cast(kinds[c]) for c, v in columns.items()]
    return pa.RecordBatch.from_arrays(
        [*arrays, pa.concat_arrays([blobs(key[at]), none]), pa.concat_arrays([blobs(check[at]), none])],
        names=[*columns, "keys", "checks"])


EDGE_SCHEMA = "k long, " + PIECE_SCHEMA + ", tag int, keys binary, checks binary"


def _sources(batches):
    """All runs of a partition: pieces that point to the first occurrence of their edges."""
    held = []
    names = [x for x, _ in _PIECE]
    for batch in batches:
        tag = np.asarray(batch.column("tag"))
        yield batch.filter(pa.array(tag == 2)).select(names)
        runs = batch.filter(pa.array(tag == 0))
        n = np.asarray(runs.column("n"))
        ahead = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        held.append([np.frombuffer(b"".join(runs.column("keys").to_pylist()), np.uint64),
                     np.frombuffer(b"".join(runs.column("checks").to_pylist()), np.uint32),
                     np.repeat(np.asarray(runs.column("doc")), n), np.repeat(np.asarray(runs.column("tie")), n),
                     np.repeat(np.asarray(runs.column("pos")), n) + ahead])
    if not held:
        return
    key, check, doc, tie, pos = (np.concatenate(x) for x in zip(*held))
    held.clear()
    order = np.lexsort((pos, tie, doc, check, key))
    key, check = key[order], check[order]
    head = np.ones(len(order), bool)
    head[1:] = (key[1:] != key[:-1]) | (check[1:] != check[:-1])
    source = order[np.flatnonzero(head)[np.cumsum(head) - 1]] if len(order) else order
    later, src = order[~head], source[~head]
    real = (doc[later] != doc[src]) | (tie[later] != tie[src]) | (pos[later] != pos[src])
    later, src = later[real], src[real]
    pieces = _compact(doc[later], tie[later], pos[later].astype(np.int32), np.ones(len(later), np.int32),
                      doc[src], tie[src], pos[src].astype(np.int32))
    for a in range(0, len(pieces[0]), 1 << 18):
        yield _piece_batches([x[a: a + (1 << 18)] for x in pieces], {})


def _paths(batches):
    """Rows (doc, tie, pieces): pieces of a document compacted to paths."""
    for batch in batches:
        lists = batch.column("pieces")
        n = np.asarray(pc.list_value_length(lists))
        flat = lists.flatten()
        fields = {x: np.asarray(flat.field(x)) for x in ("pos", "n", "sdoc", "stie", "spos")}
        pieces = _compact(np.repeat(np.asarray(batch.column("doc")), n), np.repeat(np.asarray(batch.column("tie")), n),
                          fields["pos"], fields["n"], fields["sdoc"], fields["stie"], fields["spos"])
        yield _piece_batches(pieces, {})


def _digests(k: int):
    """Rows (doc, tie, text, spans): digest of the words at each span of n edges."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                words = scan(part.column("text"), whitespace_table(), lower=False)
                raw = words.data.tobytes()
                out = {"doc": [], "tie": [], "pos": [], "n": [], "digest": []}
                for i, row in enumerate(part.select(["doc", "tie", "spans"]).to_pylist()):
                    for span in row["spans"]:
                        a = words.first[i] + span["pos"]
                        b = a + span["n"] + k - 1
                        if b > words.first[i + 1]:
                            continue
                        text = b" ".join([raw[s:e] for s, e in zip(words.start[a:b].tolist(), words.end[a:b].tolist())])
                        out["doc"].append(row["doc"])
                        out["tie"].append(row["tie"])
                        out["pos"].append(span["pos"])
                        out["n"].append(span["n"])
                        out["digest"].append(hashlib.blake2b(text, digest_size=16).digest())
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                    [("doc", pa.int64()), ("tie", pa.int64()), ("pos", pa.int32()), ("n", pa.int32()),
                     ("digest", pa.binary())]))
    return run


def _kept(k: int, with_text: bool):
    """Rows (doc, tie, text, spans): count of removed words and digest (or text) of the others."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                words = scan(part.column("text"), whitespace_table(), lower=False)
                edge = np.zeros(len(words.hash) + 1, np.int32)
                for i, spans in enumerate(part.column("spans").to_pylist()):
                    for span in spans:
                        a = words.first[i] + span["pos"]
                        edge[a] += 1
                        edge[a + span["n"] + k - 1] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                sums = np.concatenate([[0], np.cumsum(gone)])
                removed = sums[words.first[1:]] - sums[words.first[:-1]]
                texts = list(_joined(words, ~gone))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), part.column("tie"), pa.array(removed, pa.int64()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()),
                     pa.array([x.decode() for x in texts], pa.string()) if with_text
                     else pa.nulls(len(texts), pa.string())],
                    names=["doc", "tie", "n_removed", "kept_sha", "kept"])
    return run


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, tie, text): tie tells apart different texts under one id, else it is 0."""
    base = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID)).alias("doc"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    several = base.groupBy("doc").count().filter("count > 1").drop("count")
    if several.isEmpty():
        return base.select("doc", F.lit(0).cast("long").alias("tie"), "text")
    return (base.join(several.withColumn("_several", F.lit(True)), "doc", "left")
            .select("doc", F.when(F.col("_several"), F.xxhash64("text")).otherwise(F.lit(0)).alias("tie"), "text"))


def repeated_paths(base: DataFrame, k: int = K) -> tuple[DataFrame, DataFrame]:
    """(candidate documents with text, verified paths) of a keyed table."""
    spark = base.sparkSession
    parts = shuffle_partitions(spark)
    anchors = materialise(repeated(base.mapInArrow(_anchors(k), LOCAL_SCHEMA), parts)
                          .groupBy("doc", "tie").agg(F.collect_list("h").alias("anchors")))
    ids = anchors.select("doc", "tie")
    # rows that repeat an id and a text are one document
    candidates = base.join(F.broadcast(ids), ["doc", "tie"], "left_semi") if ids.count() <= MAX_IDS else base
    texts = materialise(candidates.join(anchors.hint("shuffle_hash"), ["doc", "tie"])
                        .dropDuplicates(["doc", "tie"]))
    pieces = (texts.mapInArrow(_edges(k), EDGE_SCHEMA).repartition(parts, "k")
              .mapInArrow(_sources, PIECE_SCHEMA))
    paths = materialise(pieces.groupBy("doc", "tie")
                        .agg(F.collect_list(F.struct("pos", "n", "sdoc", "stie", "spos")).alias("pieces"))
                        .mapInArrow(_paths, PIECE_SCHEMA))
    texts = texts.drop("anchors")
    spans = (paths.select("doc", "tie", "pos", "n")
             .unionByName(paths.select(F.col("sdoc").alias("doc"), F.col("stie").alias("tie"),
                                       F.col("spos").alias("pos"), "n")).distinct())
    load = spans.groupBy("doc", "tie").agg(F.ceil(F.count("*") / REQUESTS).alias("_copies"))
    asked = (spans.join(load, ["doc", "tie"])
             .groupBy("doc", "tie", F.pmod(F.xxhash64("pos", "n"), F.col("_copies")).alias("_salt"))
             .agg(F.collect_list(F.struct("pos", "n")).alias("spans")))
    digests = materialise(asked.join(texts, ["doc", "tie"]).select("doc", "tie", "text", "spans")
                          .mapInArrow(_digests(k), "doc long, tie long, pos int, n int, digest binary"))
    theirs = digests.select(F.col("doc").alias("sdoc"), F.col("tie").alias("stie"), F.col("pos").alias("spos"),
                            "n", F.col("digest").alias("_theirs"))
    verified = (paths.join(digests, ["doc", "tie", "pos", "n"]).join(theirs, ["sdoc", "stie", "spos", "n"])
                .filter("digest = _theirs").select("doc", "tie", "pos", "n", "sdoc", "stie", "spos"))
    return texts, verified


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and the kept words as ``text``) of every row."""
    base = keyed(docs, doc_id, text)
    texts, verified = repeated_paths(base, k)
    marked = verified.groupBy("doc", "tie").agg(F.collect_list(F.struct("pos", "n")).alias("spans"))
    changed = (marked.join(texts, ["doc", "tie"]).select("doc", "tie", "text", "spans")
               .mapInArrow(_kept(k, with_text), "doc long, tie long, n_removed long, kept_sha string, kept string"))
    if with_text:
        whole = base.join(changed, ["doc", "tie"], "left")
        return whole.select(F.when(F.col("doc") != _NO_ID, F.col("doc")).alias("doc_id"),
                            F.coalesce("kept", "text").alias("text"),
                            F.coalesce("n_removed", F.lit(0)).alias("n_removed"))
    whole = base.mapInArrow(_whole, "doc long, tie long, n_words long, sha string")
    return (whole.join(changed.drop("kept"), ["doc", "tie"], "left")
            .select(F.when(F.col("doc") != _NO_ID, F.col("doc")).alias("doc_id"), "n_words",
                    F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
                    F.coalesce("kept_sha", "sha").alias("kept_sha256")))


def query(spark, sf_dir: str) -> DataFrame:
    return dedup(read(spark, sf_dir, "documents"))


SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, hash(array_to_string(w[i:i + 19], ' ')) AS h1, hash('x' || array_to_string(w[i:i + 19], ' ')) AS h2
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM dw WHERE len(w) >= 20)),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY h1, h2 ORDER BY doc_id, i) AS rn FROM win)
  WHERE rn > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
word AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS p FROM dw),
kept AS (
  SELECT word.doc_id, string_agg(t, ' ' ORDER BY word.p) AS s, count(*) AS n
  FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p WHERE gone.p IS NULL GROUP BY word.doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(s, '')) AS kept_sha256
FROM dw LEFT JOIN kept ON dw.doc_id = kept.doc_id
"""
