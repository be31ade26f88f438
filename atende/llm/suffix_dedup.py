"""Repeated passages by column-wise suffix sorting of many strings.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts anywhere else. Finding
those strings takes four steps, none of which holds the collection in one place:

1. *Anchors.* Every document is cut at local minima of a rolling hash of ``SEED_BYTES`` bytes, so that
   each LENGTH-byte string contains an anchor, and equal strings contain anchors with equal hashes.
   The *fragment* of an anchor is all text that a LENGTH-byte string with this anchor can touch.
2. *Shared anchors.* Anchors whose hash occurs once are dropped. A fragment that occurs twice as a
   whole is repeated as a whole; one of its copies stays as a partner for other fragments.
3. *Column-wise construction.* The fragments that share an anchor hash meet in one task, in batches of
   bounded size. A batch is sorted from the last column on: each round puts one more symbol of every
   fragment in front and inserts the new suffixes into the Burrows-Wheeler transform and the
   common-prefix lengths of the collection, which are read from and written to sequential files.
   Neighbours in suffix order with LENGTH common bytes that start at different places are repeats.
4. *Removal.* The spans of a document are merged and cut out.

A hash that very many different fragments share is refined: a LENGTH-byte string around it reaches
at least half of the missing bytes to the left or to the right, so the fragment goes on under these two
longer keys, up to keys of LENGTH bytes, which are repeats themselves.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atende.llm.common import Stage, runs

LENGTH = 400
SEED_BYTES = 200
# Fragments of a key that one task sorts; a key with more is refined.
MOST_FRAGMENTS = 2000
# Fragments sorted at once, and positions of a document hashed at once.
BATCH = 512
# Missing bytes down to which fragments without a partner are left out before sorting.
NARROW = 8
# Rows after which a task hands on what it has found; a hand-over for each document took 30 % of the time of finding anchors on check_s.
OUT_ROWS = 1 << 13
_CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15


# --- Anchors ------------------------------------------------------------------------------


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random value of each byte, powers of the base, powers of its inverse; all modulo 2**64."""
    value = np.random.default_rng(1).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)

    def powers(base: int) -> np.ndarray:
        out = np.full(_CHUNK + 4 * LENGTH + 1, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return value, powers(_BASE), powers(pow(_BASE, -1, 1 << 64))


def rolling(b: np.ndarray, size: int) -> np.ndarray:
    """Hash of each window of ``size`` bytes; equal windows have equal hashes wherever they are."""
    value, power, inverse = _tables()
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(value[b] * power[: len(b)], out=sums[1:])
    h = (sums[size:] - sums[:-size]) * inverse[: len(b) - size + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _sliding(x: np.ndarray, w: int, op: np.ufunc, fill: int) -> np.ndarray:
    """Minimum or maximum of every window of w values."""
    n = len(x)
    padded = np.full(-(-n // w) * w, fill, x.dtype)
    padded[:n] = x
    blocks = padded.reshape(-1, w)
    ahead = op.accumulate(blocks, axis=1).reshape(-1)
    behind = op.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return op(behind[: n - w + 1], ahead[w - 1: n])


def _periodic(b: np.ndarray, at: np.ndarray, h: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, list[tuple[int, int, int, int]]]:
    """Which anchors to keep, and the stretches (start, end, period, unit) that are periodic.

    Three anchors or more of one hash at one distance d show a stretch of period d. Strings that reach
    over its left or right end are found by its first or last anchor. Strings inside a stretch of
    ``length`` + d bytes start again d bytes on, so they need no anchors; ``unit`` is the hash of the least
    rotation of the period, by which shorter stretches find a longer one. A shorter stretch may have only one
    or two anchors where d is over a third of the anchors' window, and is then not seen as a stretch: the anchors
    of the first d strings stay, so that the fragments of the longer one hold every rotation.
    """
    keep, stretches, gap = np.ones(len(at), bool), [], np.diff(at)
    tie = (h[1:] == h[:-1]) & (gap <= seed)
    edges = np.flatnonzero(np.concatenate([[True], (gap[1:] != gap[:-1]) | (tie[1:] != tie[:-1]), [True]])) if len(gap) else []
    for x, last in zip(edges[:-1], edges[1:]):
        if not tie[x] or last - x < 2:
            continue
        d, start, end = int(gap[x]), int(at[x]), int(at[last]) + seed
        if not np.array_equal(b[start: end - d], b[start + d: end]):
            continue
        while start and b[start - 1] == b[start - 1 + d]:
            start -= 1
        while end < len(b) and b[end] == b[end - d]:
            end += 1
        if not length <= end - start < length + d:
            keep[x + 1: last] = False
        if end - start >= length + d and 3 * d > length - seed + 1:
            keep[x: last] |= at[x: last] < start + d + length - seed
        if end - start >= length:
            unit = b[start: start + d].tobytes() * 2
            stretches.append((start, end, d, xxhash.xxh3_64_intdigest(min(unit[i: i + d] for i in range(d))) >> 1))
    return keep, stretches


def anchors(b: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int, int, int]]]:
    """Places and hashes of the anchors, first and last start of their strings, and the periodic stretches.

    The anchors of a string of ``length`` bytes are the places of the least hash in it: its content alone
    decides, so equal strings have anchors at equal places in them. The fragment of an anchor are the
    strings whose anchor it is; inside long periodic stretches some anchors are left out.
    """
    w, out, stretches = length - seed + 1, [], []
    windows = len(b) - length + 1
    for s in range(0, max(windows, 0), _CHUNK):
        own = b[s: min(s + _CHUNK, windows) + length - 1]
        h = rolling(own, seed)
        low = _sliding(h, w, np.minimum, (1 << 64) - 1)
        edge = np.zeros(w - 1, np.uint64)
        at = np.flatnonzero(_sliding(np.concatenate([edge, low, edge]), w, np.maximum, 0) == h)
        keep, periodic = _periodic(own, at, h[at], length, seed)
        stretches += [(x + s, y + s, *more) for x, y, *more in periodic]
        at = at[keep]
        # The run of strings with the anchor's hash as their least one, as far as they contain it.
        start = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
        end = np.append(start[1:] - 1, len(low) - 1)
        run = np.searchsorted(start, at, "right") - 1
        while len(off := np.flatnonzero(low[start[run]] != h[at])):
            run[off] -= 1
        out.append((at + s, h[at], np.maximum(at - w + 1, start[run]) + s, np.minimum(at, end[run]) + s))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, none, []
    return *(np.concatenate(x) for x in zip(*out)), stretches


def anchor_batches(batches: Iterator[pa.RecordBatch], length: int, seed: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``_anchor_rows``, of many documents at a time."""

    def joined(batch: pa.RecordBatch, parts: list[tuple]) -> pa.RecordBatch:
        n = [len(x[1]) for x in parts]
        row = pa.array(np.repeat([x[0] for x in parts], n))
        a, lo, hi, v, dig = (np.concatenate(x) for x in list(zip(*parts))[1:])
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(row), batch.column(1).take(row), pa.array(a, mask=a < 0), pa.array(lo), pa.array(hi), pa.array(v.view(np.int64)),
             pa.array(dig.view(np.int64))],
            names=["doc_id", "h", "a", "lo", "hi", "fp", "dig"],
        )

    for batch in batches:
        parts, rows = [], 0
        for i, text in enumerate(batch.column(2)):
            data = text.as_py().encode()
            a, v, lo, last, periodic = anchors(np.frombuffer(data, np.uint8), length, seed)
            hi, view = last + length, memoryview(data)
            dig = np.array([xxhash.xxh3_64_intdigest(view[x:y], seed=o - x) for x, y, o in zip(lo.tolist(), hi.tolist(), a.tolist())], np.uint64)
            if periodic:  # rows without an anchor: a is null, here -1, period and unit are in fp and dig
                x, y, d, unit = np.array(periodic, np.int64).T
                a, lo, hi = np.append(a, np.full(len(x), -1)), np.append(lo, x), np.append(hi, y)
                v, dig = np.append(v, d.astype(np.uint64)), np.append(dig, unit.astype(np.uint64))
            parts.append((i, a, lo, hi, v, dig))
            rows += len(a)
            if rows >= OUT_ROWS:
                yield joined(batch, parts)
                parts, rows = [], 0
        if rows:
            yield joined(batch, parts)


def _anchor_rows(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """(doc_id, h, a, lo, hi, fp, dig): the anchors, their fragments' places and digests."""
    return docs.where(F.octet_length("text") >= length).mapInArrow(
        lambda batches: anchor_batches(batches, length, seed), "doc_id long, h long, a long, lo long, hi long, fp long, dig long"
    )


# --- Column-wise construction -----------------------------------------------------------------


class _File:
    """An array that only grows, in a temporary file that is read and written from front to back."""

    def __init__(self, dtype: type, most: int):
        self.file, self.buffer, self.size = tempfile.TemporaryFile(buffering=0), np.zeros(most + 1, dtype), 0

    def read(self) -> np.ndarray:
        """The array, in a buffer that the next call reuses."""
        self.file.seek(0)
        out, got = self.buffer[: self.size], 0
        while got < out.nbytes:
            got += self.file.readinto(memoryview(out).cast("B")[got:])
        return out

    def write(self, x: np.ndarray) -> None:
        self.file.seek(0)
        left, self.size = memoryview(x).cast("B"), len(x)
        while left:
            left = left[self.file.write(left):]


def _inserted(x: np.ndarray, old: np.ndarray, spots: np.ndarray, values: np.ndarray | int, space: np.ndarray) -> np.ndarray:
    """``x`` at the places where ``old`` is true, the values at the others; in ``space``."""
    out = space[: len(old)]
    out[old] = x
    out[spots] = values
    return out


def collection_bwt(strings: list[bytes], most: int) -> tuple[np.ndarray, np.ndarray]:
    """Burrows-Wheeler transform and common-prefix lengths (up to ``most``) of all suffixes of the strings.

    Symbols are byte + 1 (UTF-8 has no byte 255), 0 ends a string; the ends sort by string number.
    Round j inserts the suffixes of j symbols: a suffix cX goes where the c before X ranks among all c's
    of the transform so far, and its common prefix with the last c-suffix is one more than the least
    common prefix on the way from that one's rest to X.
    """
    m, lens = len(strings), np.array([len(s) for s in strings])
    longest = int(lens.max(initial=0))
    columns = np.zeros((longest + 1, m), np.uint8)  # columns[j]: the symbol j places before the end
    for i, s in enumerate(strings):
        columns[: len(s), i] = np.frombuffer(s, np.uint8)[::-1] + 1
    total = m + int(lens.sum())
    bwt_file, lcp_file = _File(np.uint8, total), _File(np.int16, total)
    bwt_file.write(columns[0])
    lcp_file.write(np.zeros(m, np.int16))
    pos, live, place = np.arange(m), np.flatnonzero(lens > 0), np.uint32((1 << 24) - 1)
    if total >= place:
        raise ValueError("a batch holds at most 2**24 symbols")
    pair = lambda symbol, at: symbol.astype(np.uint32) << np.uint32(24) | at.astype(np.uint32)
    # All (symbol, place in the transform), sorted: where a pair stands is the place of its longer suffix.
    pairs, spare = np.empty(total, np.uint32)[:m], np.empty(total, np.uint32)
    pairs[:], ends = np.sort(pair(columns[0], np.arange(m))), int(np.count_nonzero(lens == 0))
    index, moved = np.empty(total, np.intp), np.empty(total, np.uint32)
    longer_bwt, longer_lcp = np.empty(total, np.uint8), np.empty(total, np.int16)
    for j in range(1, longest + 1):
        bwt, lcp = bwt_file.read(), lcp_file.read()
        n, k = len(bwt), len(live)
        at = np.searchsorted(pairs, pair(columns[j - 1, live], pos[live]))
        by = np.argsort(at)
        at = at[by]
        new = at - ends + m
        pos[live[by]] = new
        # The new suffixes and those right behind them get their common prefix with the one before.
        r = np.sort(np.concatenate([at, at[np.append(at[1:] != at[:-1] + 1, at[-1] + 1 < n)] + 1]))
        here, before = pairs[r], pairs[r - 1]
        value, same = np.zeros(len(r), np.int16), np.flatnonzero((here >> 24 == before >> 24) & (r > ends))
        if len(same):
            same = same[np.argsort(before[same] & place)]
            ranges = np.stack([(before[same] & place) + 1, (here[same] & place) + 1], 1).ravel().astype(np.int64)
            value[same] = np.minimum(np.minimum.reduceat(lcp_file.buffer[: n + 1], ranges)[::2] + 1, most)
        symbols, old = columns[j, live[by]], np.ones(n + k, bool)
        old[new] = False
        bwt_file.write(_inserted(bwt, old, new, symbols, longer_bwt))
        lcp = _inserted(lcp, old, new, 0, longer_lcp)
        lcp[r - ends + m] = value
        lcp_file.write(lcp)
        shift = np.repeat(np.arange(k + 1, dtype=np.uint32), np.diff(new - np.arange(k), prepend=0, append=n))
        np.bitwise_and(pairs, place, out=index[:n])
        pairs += np.take(shift, index[:n], out=moved[:n], mode="clip")
        more = np.sort(pair(symbols, new))
        spots, old = np.searchsorted(pairs, more) + np.arange(k), np.ones(n + k, bool)
        old[spots] = False
        pairs, spare = _inserted(pairs, old, spots, more, spare), pairs.base
        ends += int(np.count_nonzero(symbols == 0))
        live = live[lens[live] > j]
    return bwt_file.read().copy(), lcp_file.read().copy()


def repeated_starts(strings: list[bytes], origin: list[tuple], length: int) -> list[np.ndarray]:
    """Starts in each string of substrings of ``length`` that start at another origin as well.

    origin: (document, place of the string in it); one place of a document seen through two strings
    is no repeat.
    """
    m = len(strings)
    bwt, lcp = collection_bwt(strings, length)
    order = np.argsort(bwt, kind="stable")
    ends = int(np.count_nonzero(bwt == 0))
    forward = np.empty(len(bwt), np.int64)
    forward[order] = np.arange(len(bwt)) - ends + m
    lens = np.array([len(s) for s in strings])
    owner, start = np.empty(len(bwt), np.int64), np.empty(len(bwt), np.int64)
    pos, live = np.arange(m), np.arange(m)
    for j in range(int(lens.max(initial=0)) + 1):
        owner[pos[live]], start[pos[live]] = live, lens[live] - j
        live = live[lens[live] > j]
        pos[live] = forward[pos[live]]
    group = np.cumsum(lcp < length)
    many = np.flatnonzero(np.bincount(group)[group] > 1)
    documents = {d: k for k, d in enumerate(dict.fromkeys(d for d, _ in origin))}
    doc = np.array([documents[d] for d, _ in origin])
    place = np.array([p for _, p in origin])
    found = pd.DataFrame({"g": group[many], "i": owner[many], "s": start[many], "d": doc[owner[many]], "p": place[owner[many]] + start[many]})
    spots = found.drop_duplicates(["g", "d", "p"])["g"].value_counts()
    hit = found[found["g"].map(spots).to_numpy() > 1]
    out = [np.zeros(0, np.int64)] * m
    for i, s in hit.groupby("i")["s"]:
        out[i] = np.sort(s.to_numpy())
    return out


# --- Fragments to spans -----------------------------------------------------------------------

_SPANS = "doc_id long, h long, s long, e long"
_FRAGMENT = "doc_id long, h long, lo long, covered boolean, text binary, key long, off int, size int, slack int"


def _spans_of_starts(starts: np.ndarray, length: int) -> Iterator[tuple[int, int]]:
    cuts = np.flatnonzero(np.diff(starts) > length)
    for x, y in zip(starts[np.append(0, cuts + 1)], starts[np.append(cuts, len(starts) - 1)]):
        yield int(x), int(y) + length


def promising(texts: list[bytes], offs: list[int], size: int, slack: int) -> list[tuple[int, int] | None]:
    """The part of each fragment that can hold a string shared with another fragment of its key, or None.

    A shared string reaches at least half of the missing bytes to the left or to the right of the common
    key. Fragments that are alone under both longer keys drop out, down to NARROW missing bytes.
    """
    cands, done, length = [(i, o, o + size) for i, o in enumerate(offs)], [], size + slack
    while cands:
        longer = set()
        for i, x, y in cands:
            # The two ways differ by one byte at times, so each candidate has its own missing bytes.
            missing = length - (y - x)
            left = -(-(missing + 1) // 2)
            if missing <= NARROW:
                done.append((i, x, y))
            else:
                longer.update((i, v, w) for v, w in ((x - left, y), (x, y + missing + 1 - left)) if 0 <= v and w <= len(texts[i]))
        seen = Counter(texts[i][x:y] for i, x, y in longer)
        cands = [(i, x, y) for i, x, y in longer if seen[texts[i][x:y]] > 1]
    out: list[tuple[int, int] | None] = [None] * len(texts)
    for i, x, y in done:
        missing, old = length - (y - x), out[i] or (len(texts[i]), 0)
        out[i] = (min(old[0], max(x - missing, 0)), max(old[1], min(y + missing, len(texts[i]))))
    return out


def _sorted_spans(fragments: DataFrame, length: int) -> DataFrame:
    """Spans of the fragments that share a key with others."""

    def spans(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        batch: dict[tuple, tuple] = {}

        def flush() -> pd.DataFrame:
            rows = list(batch.values())
            batch.clear()
            found = repeated_starts([r[4] for r in rows], [((d, h), lo) for d, h, lo, _, _ in rows], length)
            out = [
                (d, h, lo + x, lo + y)
                for (d, h, lo, covered, _), starts in zip(rows, found) if len(starts) and not covered
                for x, y in _spans_of_starts(starts, length)
            ]
            return pd.DataFrame(out, columns=["doc_id", "h", "s", "e"]).astype({"doc_id": "Int64"})

        for frame, starts in runs(frames, ["key", "slack"]):
            ids = [None if d != d else int(d) for d in frame["doc_id"].tolist()]  # nulls come as NaN
            h, lo, covered, text, off, size, slack = (frame[c].tolist() for c in ("h", "lo", "covered", "text", "off", "size", "slack"))
            for x, y in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)]):
                if y - x == 1 or all(covered[x:y]):
                    continue
                for i, part in enumerate(promising(text[x:y], off[x:y], size[x], slack[x]), x):
                    if part:
                        row = (ids[i], h[i], lo[i] + part[0], covered[i], text[i][part[0]: part[1]])
                        batch.setdefault((*row[:3], len(row[4])), row)  # two refined keys may lead to one place
                if len(batch) >= BATCH:
                    yield flush()
        if batch:
            yield flush()

    return fragments.repartition("key", "slack").sortWithinPartitions("key", "slack").mapInPandas(spans, _SPANS)


def _refined(fragments: DataFrame) -> DataFrame:
    """Each fragment under the two longer keys of which a whole string must contain one."""

    def keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.to_dict("records"):
                left = -(-(r["slack"] + 1) // 2)
                for x, y in ((r["off"] - left, r["off"] + r["size"]), (r["off"], r["off"] + r["size"] + r["slack"] + 1 - left)):
                    if 0 <= x and y <= len(r["text"]):
                        key = xxhash.xxh3_64_intdigest(r["text"][x:y], seed=y - x)
                        out.append({**r, "key": key - (1 << 64) * (key >> 63), "off": x, "size": y - x, "slack": r["slack"] - (y - x - r["size"])})
            yield pd.DataFrame(out, columns=list(frame.columns)).astype({"doc_id": "Int64"})

    return fragments.mapInPandas(keys, _FRAGMENT)


def _fragment_spans(fragments: DataFrame, stage: Stage, length: int) -> list[DataFrame]:
    """Spans of all fragments (staged): small keys are sorted, larger ones refined first."""
    out, cur = [], fragments
    while True:
        sizes = stage(cur.groupBy("key", "slack").count().where("count > 1").select(F.col("key").alias("k"), F.col("slack").alias("sl"), "count"))
        same = (F.col("key") == F.col("k")) & (F.col("slack") == F.col("sl"))
        hot = sizes.where(F.col("count") > MOST_FRAGMENTS)
        if hot.isEmpty():
            return [*out, _sorted_spans(cur, length)]
        out.append(_sorted_spans(cur.join(hot, same, "left_anti"), length))
        big = cur.join(hot, same, "left_semi")
        # Keys of the full length are repeats; one place counts once.
        spots = F.struct("doc_id", "h", F.col("lo") + F.col("off"))
        exact = big.where("slack = 0").groupBy("key").agg(F.min(spots).alias("x"), F.max(spots).alias("y")).where("x != y").select(F.col("key").alias("k"))
        out.append(
            big.where("slack = 0 and not covered").join(stage(exact), F.col("key") == F.col("k"), "left_semi")
            .select("doc_id", "h", (F.col("lo") + F.col("off")).alias("s"), (F.col("lo") + F.col("off") + F.lit(length)).alias("e"))
        )
        cur = stage(_refined(big.where("slack > 0")))


def repeated_spans(docs: DataFrame, stage: Stage, length: int, seed: int) -> DataFrame:
    """(doc_id, h, s, e): spans of documents (doc_id, h, text) that repeated strings cover; may overlap."""
    rows = stage(_anchor_rows(docs, length, seed))
    found = rows.where("a is not null")
    stretches = stage(rows.where("a is null").select("doc_id", "h", F.col("lo").alias("s"), F.col("hi").alias("e"), "fp", "dig"))
    long = F.col("e") - F.col("s") >= F.lit(length) + F.col("fp")
    units = stretches.where(long).select(F.col("dig").alias("g")).distinct()
    periodic = stretches.where(long).unionByName(stretches.where(~long).join(units, F.col("dig") == F.col("g"), "left_semi")).select("doc_id", "h", "s", "e")
    digests = stage(found.groupBy("fp", "dig").agg(F.count("*").alias("n")))
    shared = stage(
        digests.groupBy("fp").agg(F.count("*").alias("kinds"), F.sum("n").alias("total")).where("total > 1").select(F.col("fp").alias("f"), "kinds")
    )
    counted = stage(
        digests.join(shared, F.col("fp") == F.col("f")).where("n > 1 or kinds > 1").select(F.col("fp").alias("f"), F.col("dig").alias("g"), "n", "kinds")
    )
    places = stage(found.join(counted, (F.col("fp") == F.col("f")) & (F.col("dig") == F.col("g"))).drop("f", "g"))
    stage.drop(rows, digests, shared, counted)
    whole = places.where(F.col("n") > 1).where(F.col("hi") - F.col("lo") >= length).select("doc_id", "h", F.col("lo").alias("s"), F.col("hi").alias("e"))
    one = places.where("kinds > 1").groupBy("fp", "dig").agg(
        F.min(F.struct("doc_id", "h", "a", "lo", "hi")).alias("x"), (F.max("n") > 1).alias("covered")
    )
    wanted = one.groupBy(F.col("x.doc_id").alias("d"), F.col("x.h").alias("hh")).agg(
        F.collect_list(F.struct("x.a", "x.lo", "x.hi", "fp", "covered")).alias("cuts")
    )
    # Equal (doc_id, h) are repeated rows with one text; the fragments are cut from one of them.
    cut = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("hh"))).select("doc_id", "h", "text", "cuts")

    names = ["doc_id", "h", "lo", "covered", "text", "key", "off", "size", "slack"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def joined(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

        for batch in batches:
            out = []
            for doc_id, h, text, cuts in zip(*(c.to_pylist() for c in batch.columns)):
                data = text.encode()
                out += [
                    (doc_id, h, c["lo"], c["covered"], data[c["lo"]: c["hi"]], c["fp"], c["a"] - c["lo"], seed, length - seed) for c in cuts
                ]
                if len(out) >= OUT_ROWS:
                    yield joined(out)
                    out = []
            if out:
                yield joined(out)

    fragments = stage(cut.mapInArrow(pieces, _FRAGMENT))
    return stage(reduce(DataFrame.unionByName, [whole, periodic, *_fragment_spans(fragments, stage, length)]))


def cut_spans(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left of the bytes, how many went, and in how many maximal runs."""
    kept, end, n = [], 0, 0
    for s, e in sorted(spans):
        if s > end or not n:
            kept.append(data[end:s])
            n += 1
        end = max(end, e)
    kept.append(data[end:])
    left = b"".join(kept)
    return left, len(data) - len(left), n


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH, seed: int = SEED_BYTES) -> DataFrame:
    """(row, r): every input row without its text, and the struct of what is left of its text.

    r: n_bytes, n_removed, n_spans, kept_sha256 of the remaining bytes, and kept_text, which drops the rest
    of a character that a cut has split. A null text is empty. Repeated rows are documents of their
    own, so each is a repeat of the other; equal or null ids do no harm, as a row is known by id and text.
    Other columns are carried as a struct and may have any name; an empty table gives an empty result.
    """
    stage = Stage(docs)
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    rows = docs.select(F.struct(*rest).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("doc_id", "text"))
    spans = repeated_spans(rows.select("doc_id", "h", "text"), stage, length, seed)
    grouped = spans.groupBy(F.col("doc_id").alias("d"), F.col("h").alias("hh")).agg(F.collect_set(F.struct("s", "e")).alias("spans"))
    joined = rows.join(grouped, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("hh")), "left").select("row", "text", "spans")
    result = T.StructType(
        [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")] + [T.StructField(n, T.StringType()) for n in ("kept_sha256", "kept_text")]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body, spans in zip(batch.column("text"), batch.column("spans")):
                data = body.as_py().encode()
                left, gone, n = cut_spans(data, [(x["s"], x["e"]) for x in spans.as_py() or ()])
                out.append((len(data), gone, n, hashlib.sha256(left).hexdigest(), left.decode(errors="ignore")))
            cols = [pa.array([o[k] for o in out], pa.int64() if k < 3 else pa.string()) for k in range(5)]
            r = pa.StructArray.from_arrays(cols, names=result.names)
            yield pa.RecordBatch.from_arrays([batch.column("row"), r], names=["row", "r"])

    return joined.mapInArrow(cut, T.StructType([joined.schema["row"], T.StructField("r", result)]))
