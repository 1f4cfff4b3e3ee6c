"""Which hashes of a document occur elsewhere too, without gathering a hot hash.

Every task first settles what repeats among its own rows: such a hash leaves the task as
one marker, and its documents are told directly.  So a shuffle partition gets at most one
row per hash and task, whatever share of all documents holds the hash.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .words import mix, released

#: k: shuffle key; tag 0: only one owner in its task; 1: marker of several; 2: told directly.  Rows of
#: tag 0 and 1 are dealt by their hash, which is k; h is 0 there and costs next to nothing when compressed
LOCAL_SCHEMA = "k long, h long, doc long, tie long, tag int"
_FIELDS = pa.schema([("k", pa.int64()), ("h", pa.int64()), ("doc", pa.int64()), ("tie", pa.int64()), ("tag", pa.int32())])


def signed(h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(h).view(np.int64)


def unsigned(column) -> np.ndarray:
    return np.asarray(column).astype(np.int64, copy=False).view(np.uint64)


def local_rows(h: np.ndarray, row: np.ndarray, doc: np.ndarray, tie: np.ndarray, twice: bool) -> pa.RecordBatch:
    """Rows of LOCAL_SCHEMA for occurrences of hash h in row ``row`` of one batch.

    ``twice``: a hash that one row holds several times counts as repeated, too.
    """
    order = np.lexsort((row, h))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)          # first of its (hash, row)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    head = np.ones(len(h), bool)         # first of its hash
    head[1:] = h[1:] != h[:-1]
    group = np.cumsum(head) - 1
    several = (np.bincount(group) if twice else np.bincount(group, new))[group] > 1 if len(h) else np.zeros(0, bool)
    single, marker, told = new & ~several, head & several, new & several
    parts = []
    for at, tag in ((single, 0), (marker, 1), (told, 2)):
        d, t = doc[row[at]], tie[row[at]]
        key = signed(mix(d.view(np.uint64) ^ t.view(np.uint64))) if tag == 2 else signed(h[at])
        own = signed(h[at]) if tag == 2 else np.zeros(len(d), np.int64)
        parts.append((key, own, d, t, np.full(len(d), tag, np.int32)))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)], schema=_FIELDS)


@released
def _settle(batches):
    """All rows of a partition: (doc, tie, h) of every hash that occurs elsewhere too."""
    held = []
    out = pa.schema([("doc", pa.int64()), ("tie", pa.int64()), ("h", pa.int64())])
    for batch in batches:
        tag = np.asarray(batch.column("tag"))
        told = batch.filter(pa.array(tag == 2))
        yield pa.RecordBatch.from_arrays([told.column(x) for x in ("doc", "tie", "h")], schema=out)
        keep = tag < 2
        held.append([np.asarray(batch.column(x))[keep] for x in ("k", "doc", "tie", "tag")])
    if held:
        h, doc, tie, tag = (np.concatenate(x) for x in zip(*held))
        held.clear()
        order = np.lexsort((tag, tie, doc, h))
        h, doc, tie, tag = h[order], doc[order], tie[order], tag[order]
        head = np.ones(len(h), bool)
        head[1:] = h[1:] != h[:-1]
        other = head.copy()  # an owner may come from several tasks: copies of one text
        other[1:] |= (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1])
        group = np.cumsum(head) - 1
        several = (np.bincount(group, other + 2 * tag) > 1)[group] if len(h) else np.zeros(0, bool)
        at = several & other & (tag == 0)
        for a in range(0, int(at.sum()), 1 << 18):
            part = np.flatnonzero(at)[a: a + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(x[part]) for x in (doc, tie, h)], schema=out)


def repeated(local: DataFrame, partitions: int) -> DataFrame:
    """(doc, tie, h) of the hashes that occur more than once, from rows of LOCAL_SCHEMA."""
    return local.repartition(partitions, "k").mapInArrow(_settle, "doc long, tie long, h long")


#: keys of one slice in one bucket of keys, as the planes of their leading bytes and of their owners' marks, and their owners; tags as above
PACKED_SCHEMA = "bucket int, tag int, keys binary, owners binary"
PACKED_BYTES = 6   # of a key; what two keys share beyond them is for the caller to find out
SPREAD = 4         # buckets for each shuffle partition


def packed_rows(h: np.ndarray, row: np.ndarray, owner: np.ndarray, buckets: int, marks: np.ndarray | None = None,
                width: int = PACKED_BYTES) -> pa.RecordBatch:
    """Rows of PACKED_SCHEMA for occurrences of evenly spread keys h in row ``row`` of one slice.

    ``marks``: a byte of each row (0 without), by which ``repeated_owners`` may tell owners apart;
    ``width``: bytes of a key, here and there.
    """
    marks = np.zeros(len(owner), np.uint8) if marks is None else marks
    h = h >> np.uint64(64 - 8 * width)
    order = np.lexsort((row, h))
    h, row = h[order], row[order]
    new, head = np.ones(len(h), bool), np.ones(len(h), bool)
    head[1:] = h[1:] != h[:-1]
    new[1:] = head[1:] | (row[1:] != row[:-1])
    several = (np.bincount(np.cumsum(head) - 1, new) > 1)[np.cumsum(head) - 1] if len(h) else new
    parts = ((tag, h[at], owner[row[at]], marks[row[at]])
             for tag, at in enumerate((new & ~several, head & several, new & several)))
    return _packed(parts, buckets, width)


def packed_local(local: pa.RecordBatch, turned: Callable, buckets: int, width: int) -> pa.RecordBatch:
    """Rows of PACKED_SCHEMA for rows of LOCAL_SCHEMA; ``turned`` makes evenly spread keys of hashes, and doc is the owner."""
    tags, doc = np.asarray(local.column("tag")), np.asarray(local.column("doc"))
    parts = []
    for tag in range(3):
        at = np.flatnonzero(tags == tag)
        key = turned(unsigned(local.column("h" if tag == 2 else "k"))[at]) >> np.uint64(64 - 8 * width)
        order = np.argsort(key)
        parts.append((tag, key[order], doc[at[order]], np.zeros(len(at), np.uint8)))
    return _packed(parts, buckets, width)


def _packed(parts, buckets: int, width: int) -> pa.RecordBatch:
    """Rows of PACKED_SCHEMA for (tag, ascending keys of ``width`` bytes, owners, marks)."""
    out = []
    for tag, key, own, mark in parts:
        dealt = mix(own.view(np.uint64)) >> np.uint64(64 - 8 * width) if tag == 2 else key
        bucket = ((dealt >> np.uint64(8 * width - 24)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)
        if tag == 2:
            by = np.argsort(bucket, kind="stable")
            key, own, mark, bucket = key[by], own[by], mark[by], bucket[by]
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        for a, b in zip(first.tolist(), np.append(first[1:], len(bucket)).tolist()):
            planes = key[a:b].astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width:].T
            out.append((int(bucket[a]), tag, planes.tobytes() + mark[a:b].tobytes(), b"" if tag == 1 else own[a:b].tobytes()))
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(
        (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names=["bucket", "tag", "keys", "owners"])


def _unpacked(table: pa.Table, tag: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, owners, marks) of the rows of a tag; owners of markers are 0."""
    rows = table.filter(pa.array(np.asarray(table.column("tag")) == tag))
    keys, marks = [], []
    for blob in rows.column("keys").to_pylist():
        planes = np.frombuffer(blob, np.uint8).reshape(width + 1, -1)
        wide = np.zeros((planes.shape[1], 8), np.uint8)
        wide[:, 8 - width:] = planes[:width].T
        keys.append(wide.view(">u8").reshape(-1).astype(np.int64))
        marks.append(planes[width])
    keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
    marks = np.concatenate(marks) if marks else np.zeros(0, np.uint8)
    return keys, np.zeros(len(keys), np.int64) if tag == 1 else np.frombuffer(b"".join(rows.column("owners").to_pylist()), np.int64), marks


def _settle_packed(apart: int, width: int):
    def run(table: pa.Table) -> pa.Table:
        """All rows of a bucket: (key, node) of every key that has another owner, too, whose mark is not further apart."""
        told = _unpacked(table, 2, width)
        (key, node, mark), (marked, none, blank) = _unpacked(table, 0, width), _unpacked(table, 1, width)
        marker = np.repeat([0, 2], [len(key), len(marked)])
        key, node, mark = np.concatenate([key, marked]), np.concatenate([node, none]), np.concatenate([mark, blank]).astype(np.int64)
        order = np.lexsort((marker, node, key))
        key, node, mark, marker = key[order], node[order], mark[order], marker[order]
        head = np.ones(len(key), bool)
        head[1:] = key[1:] != key[:-1]
        other = head.copy()  # an owner may come from several slices: lines that repeat
        other[1:] |= (node[1:] != node[:-1]) | (marker[1:] != marker[:-1])
        group = np.cumsum(head) - 1
        several = (np.bincount(group, other + marker) > 1)[group] if len(key) else head
        far = (np.bincount(group, marker) > 0)[group] if len(key) else head  # several owners of a slice, of any marks
        at = np.flatnonzero(several & other & (marker == 0))
        at = at[np.lexsort((mark[at], key[at]))]
        # those whose marks are nearest are neighbours now
        near = (key[at[1:]] == key[at[:-1]]) & (mark[at[1:]] - mark[at[:-1]] <= apart)
        fit = far[at]
        fit[1:] |= near
        fit[:-1] |= near
        at = at[fit]
        return pa.table({"key": pa.array(np.concatenate([key[at], told[0]])), "node": pa.array(np.concatenate([node[at], told[1]]))})
    return run


def repeated_owners(packed: DataFrame, apart: int = 255, width: int = PACKED_BYTES) -> DataFrame:
    """(key, node) of the keys that more than one node owns, from rows of PACKED_SCHEMA; a pair may come again.

    Nodes are left out of which the marks of all other owners are more than ``apart`` from theirs.
    """
    return packed.groupBy("bucket").applyInArrow(_settle_packed(apart, width), "key long, node long")
