"""Exact Jaccard join of shingle sets with adaptive multi-match prefixes.

A document's set is its distinct five-word shingles (as 64-bit hashes). Under one
global order of shingles, two sets with Jaccard similarity t share at least l shingles
among the first ``n - ceil(t n) + l`` of each, for every l up to the needed overlap. Each
document takes the l that is cheapest for it: a longer prefix meets more posting lists,
but asks for more common shingles before a pair is verified. A pair needs the smaller
of its two l. No link is lost, whatever the estimates.

The order puts shingles that may be frequent last, the rest by hash. A count sketch of
fixed size, filled in one pass, points out buckets above the noise; a shingle in such a
bucket counts as frequent, with the bucket's excess as its estimate. Wrong estimates
cost time, never links.

Work stays near linear in large groups: equal sets are one node; in a few rounds the
nodes of a posting list are tried with one of them, which joins a group of near copies
to one component; only pairs between different components remain to be looked at, by a
join where lists are short and block by block where they are long. Sharing a component
already, the skipped pairs cannot change it. Before sets are moved and compared, bit
signatures rule out pairs: shingles are hashed to bits by parity, so each differing bit
stands for a shingle that only one set has.

What is moved lies on disk until it has been read. Where it may be much, tables are made in
parts, each over a share of the lists, nodes or blocks, and what a part has moved goes
before the next is made. Texts are never moved: the ids of those whose sets are compared
go to them, so many at a time.

Defined results: words are split at ASCII white space after lower-casing A-Z; fewer
than five words make one shingle; texts that are null or have no word have no shingle,
link with nothing and form their own component; repeated rows share a set; the id of a
component is the smallest document id in it; rows without an id link like all others,
and a component of such rows only has a null id.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import batched

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallystream.llm.common import SMALL_BATCHES, let_go, restart_point, scratch, stored
from tallystream.workspace import settings

WIDTH = 5
NEED, OF = 75, 100  # Jaccard similarity as a fraction
SKETCH = 1 << 20  # buckets
CHUNKS = 1 << 10  # of the sketch, each moved as one row
FREQUENT = 48  # least excess of a bucket that stands out
LONGEST = 12  # largest l
STAR_ROUNDS = 8  # at most, before all pairs that are left
WORTH = 10  # a round that links less than one of so many pairs tried is the last
EDGES = 1 << 17  # connected in one task, about
FOREST_ROUNDS = 6  # at most, before the pairs that are left are verified
NEAREST = 2  # partners of a node that are tried before all
DENSE = 4  # pairs for each node from which such rounds are worth it
SHORT = 64  # nodes of a posting list whose pairs are joined
BLOCK = 2048  # nodes of a family that are looked at together
BLOCK_TOKENS = 1 << 20  # of a block, about
PART = 1 << 14  # tokens whose incidence is held at a time
MOST_BITS = 1 << 14  # of a signature
COARSE = 128  # bytes of a signature that all pairs of two blocks are compared by
VERIFY_COST = 0.5  # of one shingle when verifying, in posting entries
LISTED = 1 << 26  # shingles of documents whose lists are made at once, about
LIST_PARTS = 4  # at most, since each reads all prefixes
OPENED = 1 << 23  # entries whose lists are looked at together, about
OPEN_PARTS = 8  # at most, since each reads all entries
MOVED = 1 << 24  # shingles, or as much of signatures and tokens, moved at once in any case
MOVED_SHARE = 4  # or one in so many of the shingles of all documents
ASKED = 1 << 18  # nodes whose ids go to all texts at once, about
PAIRED = 1 << 24  # pairs made from short lists at once in any case
PAIRED_SHARE = 4  # or for each of their entries, which move again for each part

# Shingles as 64-bit hashes

CHUNK = 1 << 18  # bytes looked at together
ROWS = 512  # handed on together
REMEMBERED = 1 << 17  # sets of a task whose prefixes have been listed
_random = np.random.default_rng(20240101)
_BYTES = _random.integers(0, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES[65:91] = _BYTES[97:123]  # A-Z count as a-z
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE, _STEP, _M1, _M2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53))
_powers = np.ones(1, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _M1
    h = (h ^ (h >> np.uint64(33))) * _M2
    return h ^ (h >> np.uint64(33))


def _word_hashes(raw: np.ndarray) -> np.ndarray:
    """One hash per word: its bytes weighted by powers of an odd number."""
    global _powers
    space = _IS_SPACE[raw]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    sizes = ends - starts
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    place = np.arange(sizes.sum()) - np.repeat(first, sizes)
    if sizes.max() > len(_powers):
        _powers = np.concatenate(([np.uint64(1)], np.cumprod(np.full(int(sizes.max()) * 2, _BASE))))
    return _mixed(np.add.reduceat(_BYTES[raw[~space]] * _powers[place], first))


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The distinct shingles in order, as signed 64-bit hashes.

    Texts shorter than a shingle count whole.
    """
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    pieces, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + CHUNK)
        if end < len(raw):  # cut at the first white space after the chunk
            tail = np.flatnonzero(_IS_SPACE[raw[end:]][: 16 * CHUNK])
            end = end + int(tail[0]) if len(tail) else len(raw)
        pieces.append(_word_hashes(raw[at:end]))
        at = end
    w = np.concatenate(pieces) if pieces else np.empty(0, dtype=np.uint64)
    if not len(w):
        return np.empty(0, dtype=np.int64)
    span = min(width, len(w))
    h = np.full(len(w) - span + 1, span, dtype=np.uint64)
    for k in range(span):
        h = h * _STEP + w[k : len(w) - span + 1 + k]
    return np.unique(_mixed(h).view(np.int64))


def signature(hashes: np.ndarray) -> bytes:
    """Parity of the shingles per bit; four to eight bits for each shingle, within limits."""
    bits = min(MOST_BITS, 4 << max(4, int(len(hashes) - 1).bit_length()))
    return np.packbits(np.bincount(hashes & (bits - 1), minlength=bits).astype(np.uint8) & 1).tobytes()


def _folded(bits: bytes, size: int) -> np.ndarray:
    """A signature of ``size`` bytes, as words, whose parities are sums of the longer one's."""
    x = np.frombuffer(bits, dtype=np.uint64)
    while len(x) * 8 > size:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def _apart(one: bytes, other: bytes) -> int:
    """A lower bound of the number of shingles that only one of two sets has."""
    size = min(len(one), len(other))
    return int(np.bitwise_count(_folded(one, size) ^ _folded(other, size)).sum())


def _may_be_similar(s1: pd.Series, s2: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    # |x & y| >= t / (1 + t) (n1 + n2), so the sets differ in (1 - t) / (1 + t) (n1 + n2) at most.
    most = (OF - NEED) * (n1 + n2) / (OF + NEED)
    return pd.Series([_apart(a, b) for a, b in zip(s1, s2, strict=True)], dtype="float64") <= most


# Pairs within families of long posting lists


def _block_pairs(rows: list[tuple], nearest: int | None = None) -> Iterator[tuple[int, int]]:
    """Pairs of a family, within one block or between two, that may be similar; with
    ``nearest`` only so many for each node, by signature.

    A row is (side, a, n, l, root, more, bits, tokens): the tokens are those of its long
    lists, ``more`` says whether it is in short lists too. A pair must share a token, as
    many as the smaller l unless short lists may hold the rest, and sizes and signatures
    must allow similarity.
    """
    rows.sort(key=lambda r: r[1])
    size = min(COARSE, min(len(r[6]) for r in rows))
    bits = np.stack([_folded(r[6], size) for r in rows])
    side, n, l, root, more = np.array([(r[0], r[2], r[3], r[4], r[5]) for r in rows], dtype=np.int64).T
    row, column, width = _shared_tokens([r[7] for r in rows])
    parts = range(0, max(1, width), PART)
    whole = _incidence(row, column, len(rows), 0) if len(parts) == 1 else None
    step = max(1, (1 << 18) // len(rows))
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    for first in range(0, len(rows), step):
        own = np.arange(first, min(first + step, len(rows)))
        # Within one block each pair once; of two blocks only pairs across.
        keep = (root[own, None] != root) & (own[:, None] > np.arange(len(rows))) & ((side[own, None] != side) | (side == 2))
        keep &= np.minimum(n[own, None], n) * OF >= np.maximum(n[own, None], n) * NEED
        apart = np.zeros(keep.shape, dtype=np.int64)
        for k in range(bits.shape[1]):
            apart += np.bitwise_count(bits[own, k][:, None] ^ bits[:, k])
        keep &= apart * (OF + NEED) <= (OF - NEED) * (n[own, None] + n)
        i, j = np.nonzero(keep)
        waiting.append((i + first, j))
        if sum(len(x) for x, _ in waiting) < 1 << 18 and own[-1] + 1 < len(rows):
            continue
        i, j = (np.concatenate(x) for x in zip(*waiting, strict=True))
        waiting = []
        common = np.zeros(len(i), dtype=np.int64)
        for part in parts:
            has = whole if whole is not None else _incidence(row, column, len(rows), part)
            for k in range(0, len(i), 4096):
                common[k : k + 4096] += np.bitwise_count(has[i[k : k + 4096]] & has[j[k : k + 4096]]).sum(1, dtype=np.int64)
        keep = common >= np.where((more[i] & more[j]) > 0, 1, np.minimum(l[i], l[j]))
        found = []
        for x, y in zip(i[keep].tolist(), j[keep].tolist(), strict=True):
            one, other = rows[x], rows[y]
            apart = _apart(one[6], other[6])
            if apart * (OF + NEED) <= (OF - NEED) * (one[2] + other[2]):
                found.append((one[1], other[1], apart / (one[2] + other[2])))
        pairs = pd.DataFrame(found, columns=["u", "v", "apart"])
        if nearest is not None:  # all pairs of a node and those before it are found together
            pairs = pairs.sort_values(["apart", "v"], kind="stable").groupby("u", sort=False).head(nearest)
        yield from zip(pairs["u"].tolist(), pairs["v"].tolist(), strict=True)


def _shared_tokens(tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """Row and number of every entry of a token that several rows have, and how many such tokens there are."""
    values, at = np.unique(np.concatenate(tokens), return_inverse=True)
    several = np.bincount(at) > 1
    place = np.cumsum(several) - 1
    row = np.repeat(np.arange(len(tokens)), [len(x) for x in tokens])
    entry = several[at]
    return row[entry], place[at[entry]], int(several.sum())


def _incidence(row: np.ndarray, column: np.ndarray, rows: int, first: int) -> np.ndarray:
    """Which row has which of the ``PART`` tokens from ``first`` on, as bits."""
    most = int(column.max(initial=0)) + 1 - first
    has = np.zeros((rows, min(PART, -(-max(1, most) // 64) * 64)), dtype=bool)
    own = (column >= first) & (column < first + PART)
    has[row[own], column[own] - first] = True
    return np.packbits(has, axis=1).view(np.uint64)


def _pairs_of_families(nearest: int | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by family and pair of blocks, which may go on in the next batch."""
        columns = ["side", "a", "n", "l", "root", "more", "bits", "tokens"]
        key, rows = None, []

        def pairs() -> Iterator[pd.DataFrame]:
            for part in batched(_block_pairs(rows, nearest) if len(rows) > 1 else (), 1 << 16):
                yield pd.DataFrame(part, columns=["u", "v"])

        for batch in batches:
            keys = zip(batch["family"], batch["i"], batch["j"], strict=True)
            for new, row in zip(keys, zip(*(batch[c] for c in columns), strict=True), strict=True):
                if new != key:
                    yield from pairs()
                    key, rows = new, []
                rows.append(row)
        yield from pairs()

    return run


def _family_pairs(members: DataFrame, roots: DataFrame | None, nearest: int | None = None, parts: int = 1) -> list[DataFrame]:
    """Pairs (u, v) of different components, by comparing the blocks of every family: each
    part has those of some pairs of blocks."""
    spread = _with_roots(members, roots).withColumn("own", F.pmod(F.xxhash64(F.lit(3), "a"), F.col("blocks")).cast("int"))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(low == high, 2).when(F.col("own") == low, 0).otherwise(1)
    spread = spread.select("family", low.alias("i"), high.alias("j"), side.alias("side"), "a", "n", "l", "root", "more", "bits", "tokens")

    def pairs(part: DataFrame) -> DataFrame:
        dealt = part.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j")
        return dealt.mapInPandas(_pairs_of_families(nearest), "u bigint, v bigint")

    return [pairs(part) for part in _shares(spread, parts, "family", "i", "j")]


def _family_parts(members: DataFrame, most: int) -> int:
    """Into how many parts the pairs of blocks go: a member is moved once for each block of its family."""
    # In the room of a shingle.
    size = (F.octet_length("bits") / 8 + F.size("tokens") + 8) * F.col("blocks")
    return _parts_for(members.agg(F.sum(size)).first()[0], most)


# Parts


def _parts_for(all_: float | None, most: float) -> int:
    return max(1, int(-(-(all_ or 0) // most)))


def _shares(rows: DataFrame, parts: int, *by: str | Column) -> list[DataFrame]:
    """The rows in so many parts; those that agree in ``by`` stay together."""
    if parts == 1:
        return [rows]
    share = F.pmod(F.xxhash64(F.lit(5), *by), F.lit(parts))
    return [rows.where(share == part) for part in range(parts)]


def _stored(spark: SparkSession, parts: Iterable[DataFrame], name: str) -> DataFrame:
    """The rows of all parts as stored tables; what a part has moved goes before the next is made."""
    done = []
    for part in parts:
        done.append(stored(spark, part, name))
        let_go(spark)
    return reduce(DataFrame.unionByName, done)


# Frequent shingles


def _sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts = np.zeros(SKETCH, dtype=np.int64)
    for batch in _parts(batches):
        found = [_low(shingles(text)) for text in batch["text"]]
        if found:
            counts += np.bincount(np.concatenate(found) & (SKETCH - 1), minlength=SKETCH)
    if counts.any():
        yield _chunk_rows(dict(enumerate(counts.reshape(CHUNKS, -1))))


def _chunk_rows(chunks: dict[int, np.ndarray]) -> pd.DataFrame:
    return pd.DataFrame({"chunk": list(chunks), "n": [x.tobytes() for x in chunks.values()]})


def _summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One sum for each chunk, held in memory of the sketch's size at most."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, raw in zip(batch["chunk"].tolist(), batch["n"], strict=True):
            sums[chunk] = sums.get(chunk, 0) + np.frombuffer(raw, dtype=np.int64)
    yield _chunk_rows(sums)


def _low(hashes: np.ndarray) -> np.ndarray:
    """The half of the shingles that prefixes are mostly made of."""
    return hashes[hashes < 0]


def frequent_buckets(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the sketch that stand out, in order, and their excess over the usual count."""
    parts = texts.mapInPandas(_sketched, "chunk int, n binary")
    chunks = parts.repartition("chunk").mapInPandas(_summed, "chunk int, n binary").toPandas()  # of the sketch's size
    total = np.zeros((CHUNKS, SKETCH // CHUNKS), dtype=np.int64)
    for chunk, raw in zip(chunks["chunk"], chunks["n"], strict=True):
        total[chunk] = np.frombuffer(raw, dtype=np.int64)
    total = total.ravel()
    middle = int(np.median(total))
    buckets = np.flatnonzero(total > middle + max(FREQUENT, 6 * middle**0.5))
    return buckets, total[buckets] - middle


# Prefixes


def _prefix(hashes: np.ndarray, buckets: np.ndarray, excess: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The cheapest l with its prefix, and which shingles of the prefix may be frequent."""
    n = len(hashes)
    need = -(-NEED * n // OF)
    rank = np.ones(n, dtype=np.int64)
    if len(buckets):
        own = hashes & (SKETCH - 1)
        where = np.minimum(np.searchsorted(buckets, own), len(buckets) - 1)
        rank = np.where((buckets[where] == own) & (hashes < 0), excess[where], 1)
    order = np.concatenate((np.flatnonzero(rank == 1), np.flatnonzero(rank > 1)))
    most = min(LONGEST, need)
    first = n - need + 1
    load = np.cumsum(rank[order[: first + most - 1]] - 1)
    lengths = np.arange(first, first + most)
    cost = load[lengths - 1] * (1 + VERIFY_COST * n / np.arange(1, most + 1) ** 2) + lengths
    matches = int(cost.argmin()) + 1
    chosen = order[: first + matches - 1]
    return hashes[chosen], rank[chosen] > 1, matches


_FNV = np.uint64(0x100000001B3)


def _digests(hashes: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit digests of a set."""
    u = hashes.view(np.uint64)
    a = _mixed(np.array([_mixed(u).sum() + np.uint64(len(u))], dtype=np.uint64))
    b = _mixed(np.array([_mixed(u * _STEP ^ _BASE).sum() ^ (np.uint64(len(u)) * _FNV)], dtype=np.uint64))
    return int(a.view(np.int64)[0]), int(b.view(np.int64)[0])


def _parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for i in range(0, len(batch), ROWS):
            yield batch.iloc[i : i + ROWS]


def _signed(buckets: np.ndarray, excess: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Equal sets are one node, so a task lists the prefix of a set once. Of more sets than
        # are remembered some are listed again, which only adds rows that are dropped later.
        listed: set[tuple[int, int]] = set()
        none = np.empty(0, dtype=np.int64)
        for part in _parts(batches):
            rows = []
            if len(listed) > REMEMBERED:
                listed.clear()
            for text in part["text"]:
                h = shingles(text)
                digests = _digests(h)
                prefix, often, matches = _prefix(h, buckets, excess) if len(h) else (h, np.empty(0, bool), 0)
                again = digests in listed
                listed.add(digests)
                lists = (none, none) if again else (prefix[~often], prefix[often])
                rows.append((*digests, len(h), matches, signature(h), *lists))
            out = pd.DataFrame(rows, columns=["a", "b", "n", "l", "bits", "rare", "often"])
            for name in KEY:
                out[name] = part[name].to_numpy()
            yield out

    return run


# A row's id (0 without one), whether it has none, and the hash of its text: no nulls,
# which pandas would turn whole ids into floats for.
KEY = ("doc_id", "unnamed", "h")
SIGNED = "doc_id bigint, unnamed boolean, h bigint, a bigint, b bigint, n bigint, l int, bits binary, rare array<bigint>, often array<bigint>"


def _keyed(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    doc_id = F.col(id_col).cast("bigint")
    key = F.coalesce(doc_id, F.lit(0)).alias("doc_id"), doc_id.isNull().alias("unnamed"), F.xxhash64(text_col).alias("h")
    return documents.select(*key, F.col(text_col).alias("text"))


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in _parts(batches):
        found = [shingles(t) for t in batch["text"]]
        yield pd.DataFrame({"a": [_digests(h)[0] for h in found], "sh": found})


def _enough(common: Column, n1: Column, n2: Column) -> Column:
    return common * OF >= NEED * (n1 + n2 - common)


def _sizes_fit(n1: Column, n2: Column) -> Column:
    return (F.least(n1, n2) * OF) >= (F.greatest(n1, n2) * NEED)


def _close(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Of pairs (u, v) of nodes, those that signatures do not rule out."""
    one = nodes.select(F.col("a").alias("u"), F.col("bits").alias("s1"), F.col("n").alias("n1"))
    two = nodes.select(F.col("a").alias("v"), F.col("bits").alias("s2"), F.col("n").alias("n2"))
    may_be = F.pandas_udf(_may_be_similar, "boolean")
    return pairs.join(one, "u").join(two, "v").where(may_be("s1", "s2", "n1", "n2")).select("u", "v")


def _sets_by(docs: DataFrame, few: DataFrame) -> DataFrame:
    """The sets (a, sh) of the nodes (a, doc_id), maybe with others: an id may stand at several texts."""
    ids = F.broadcast(few.select("doc_id"))  # of about ``ASKED`` nodes at most; else all texts would be moved
    return docs.join(ids, "doc_id", "left_semi").mapInPandas(_sets, "a bigint, sh array<bigint>")


def _verified(docs: DataFrame, close: DataFrame, nodes: DataFrame, most: int, name: str) -> DataFrame:
    """Of stored pairs (u, v) of nodes, those whose sets are similar enough, as stored tables.

    About ``most`` shingles are moved at once, or those of one node if it has more.
    """
    spark = docs.sparkSession
    # The sets of the nodes left, each from one document.
    few = stored(spark, _ends(nodes, close).select("a", *KEY, "n"), f"jaccard-{name}-nodes")
    held = few.agg(F.count("*").alias("nodes"), F.sum("n").alias("n"), F.max("unnamed").alias("unnamed")).first()
    # A set moves once to the pairs it is in, then with each pair that it is the first of.
    pairs = close.count()
    moved = (held["n"] or 0) * (1 + pairs / max(1, held["nodes"]))
    parts = max(_parts_for(held["nodes"], ASKED), _parts_for(moved, most))
    if parts == 1:
        return _stored(spark, [_similar(docs, close, few, held["unnamed"])], "loop")
    # The pairs of a node that many are tried with stay together, unless they would fill a part.
    full = [r["v"] for r in close.groupBy("v").count().where(F.col("count") * 2 * parts > pairs).collect()]  # 2 * parts at most
    own = _shares(close, parts, F.when(F.col("v").isin(full), F.col("u")).otherwise(F.col("v")))
    return _stored(spark, (_similar(docs, some, _ends(few, some), held["unnamed"]) for some in own), "loop")


def _ends(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The nodes that are in pairs (u, v)."""
    return nodes.join(pairs.select(F.explode(F.array("u", "v")).alias("a")).distinct(), "a", "left_semi")


def _similar(docs: DataFrame, close: DataFrame, few: DataFrame, unnamed: bool | None) -> DataFrame:
    """Of pairs (u, v) of the nodes ``few``, those whose sets are similar enough."""
    sets = _sets_by(docs.where("NOT unnamed").select("doc_id", "text"), few.where("NOT unnamed").select("a", "doc_id"))
    if unnamed:
        # No document of these nodes has an id: by the hash of the text, of which any number
        # of documents may be copies.
        by_text = F.col("h").alias("doc_id")
        loose, texts = few.where("unnamed").select("a", by_text), docs.where("unnamed").select(by_text, "text")
        texts = texts.join(F.broadcast(loose.select("doc_id")), "doc_id", "left_semi").distinct()
        sets = sets.unionByName(_sets_by(texts, loose))
    left = sets.select(F.col("a").alias("u"), F.col("sh").alias("sh1"))
    right = sets.select(F.col("a").alias("v"), F.col("sh").alias("sh2"))
    both = close.join(left, "u").join(right, "v")
    common = F.size(F.array_intersect("sh1", "sh2"))
    return both.where(_enough(common, F.size("sh1"), F.size("sh2"))).select("u", "v").distinct()


def _stars(u: np.ndarray, v: np.ndarray) -> pd.DataFrame:
    """Edges from every node straight to the least one that these edges connect it with."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    u, v = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while (root[u] != root[v]).any():
        one, other = root[u], root[v]
        np.minimum.at(root, one, other)
        np.minimum.at(root, other, one)
        while (root[root] != root).any():
            root = root[root]
    led = np.flatnonzero(root != np.arange(len(nodes)))
    return pd.DataFrame({"u": nodes[led], "v": nodes[root[led]]})


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The stars of a task's edges, of twice ``EDGES`` at a time."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= 2 * EDGES:
            yield _stars(*(np.concatenate([x[c] for x in held]) for c in "uv"))
            held = []
    if held:
        yield _stars(*(np.concatenate([x[c] for x in held]) for c in "uv"))


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``node, root``: the smallest node reachable, for every node of ``links(u, v)``.

    Tasks first connect the edges they hold. Where those are of more than one task, this
    alternates with large and small stars until every edge leads straight to a root.
    """
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    while True:
        edges = restart_point(spark, edges)
        tasks = max(1, -(-edges.count() // EDGES))
        edges = restart_point(spark, edges.coalesce(tasks).mapInPandas(_forest, "u bigint, v bigint"))
        if tasks == 1 or not _unsettled(edges):
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        edges = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _unsettled(edges: DataFrame) -> bool:
    """Whether a node has several edges to lower ones, or one of its lower ones has such an edge itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    ends = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return ends.where("down > 1 OR (down = 1 AND up = 1)").count() > 0


def merged(spark: SparkSession, roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """``node, root`` after further links: only the components that they connect are looked at."""
    if roots is None:
        return components(spark, links)
    one = roots.select(F.col("node").alias("u"), F.col("root").alias("r1"))
    two = roots.select(F.col("node").alias("v"), F.col("root").alias("r2"))
    between = links.join(one, "u", "left").join(two, "v", "left").select(F.coalesce("r1", "u").alias("u"), F.coalesce("r2", "v").alias("v"))
    more = components(spark, between)
    known = roots.join(more.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
    known = known.select("node", F.coalesce("top", "root").alias("root"))
    return restart_point(spark, known.unionByName(more.join(roots, "node", "left_anti")))


def _with_roots(entries: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return entries.withColumn("root", F.col("a"))
    return entries.join(roots.withColumnRenamed("node", "a"), "a", "left").withColumn("root", F.coalesce("root", "a"))


def _apart_pairs(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (u, v) whose nodes are in different components."""
    one = roots.select(F.col("node").alias("u"), F.col("root").alias("r1"))
    two = roots.select(F.col("node").alias("v"), F.col("root").alias("r2"))
    apart = F.coalesce("r1", "u") != F.coalesce("r2", "v")
    return pairs.join(one, "u", "left").join(two, "v", "left").where(apart).select("u", "v")


def _entries(wide: DataFrame, parts: int = 1) -> list[DataFrame]:
    """Entries (t, a) of posting lists, in parts by list: a node comes once from every task that has met it.

    Lists of rare shingles are short, since their buckets did not stand out, and those of one
    node go, where they lie; the others combine before they are moved. The bucket decides
    which a shingle is, so no entry is in both.
    """
    in_list = Window.partitionBy("t")
    rare = _shares(wide.select(F.explode("rare").alias("t"), "a"), parts, "t")
    rare = [r.withColumn("lo", F.min("a").over(in_list)).withColumn("hi", F.max("a").over(in_list)).where("lo <> hi") for r in rare]
    often = _shares(wide.select(F.explode("often").alias("t"), "a"), parts, "t")
    return [r.select("t", "a").distinct().unionByName(o.distinct()) for r, o in zip(rare, often, strict=True)]


def _turned(node: Column, bits: int) -> Column:
    """A node's 64 bits moved to the left, those that fall out put in on the right."""
    return F.shiftleft(node, bits).bitwiseOR(F.shiftrightunsigned(node, 64 - bits))


def _star_pairs(shared: DataFrame, nodes: DataFrame, roots: DataFrame | None, step: int) -> DataFrame:
    """Pairs (u, v) of different components that share four lists whose first node is v.

    The first is the least by the node's bits from the eighth of ``step`` on, so entries are
    moved without sizes and components; these are looked up for the pairs that are left.
    """
    turn = 8 * step % 64
    first = shared.groupBy("t").agg(F.min(_turned(F.col("a"), turn)).alias("p"))
    met = shared.join(first, "t").select(F.col("a").alias("u"), _turned(F.col("p"), 64 - turn).alias("v")).where("u <> v")
    tries = met.groupBy("u", "v").agg(F.count("*").alias("c")).where("c >= 4").select("u", "v")
    one = nodes.select(F.col("a").alias("u"), F.col("n").alias("n1"))
    two = nodes.select(F.col("a").alias("v"), F.col("n").alias("n2"))
    tries = tries.join(one, "u").join(two, "v").where(_sizes_fit(F.col("n1"), F.col("n2"))).select("u", "v")
    return tries if roots is None else _apart_pairs(tries, roots)


def _open(shared: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The entries of lists that nodes of several components are in; those of a list come together."""
    held = _with_roots(shared, roots)
    lists = held.groupBy("t").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("c"), F.min("a").alias("head"))
    lists = lists.where("lo <> hi").select("t", "c", "head")
    return held.join(lists, "t").withColumn("long", (F.col("c") > SHORT).cast("int"))


def _short_pairs(few: DataFrame, parts: int) -> list[DataFrame]:
    """Pairs (u, v) of different components that share enough of their short lists, in parts by u."""
    y = few.alias("y")
    close = (F.col("x.t") == F.col("y.t")) & (F.col("x.a") > F.col("y.a")) & (F.col("x.root") != F.col("y.root")) & _sizes_fit(F.col("x.n"), F.col("y.n"))
    least = F.when(F.col("x.more") + F.col("y.more") == 2, 1).otherwise(F.least("x.l", "y.l"))

    def pairs(x: DataFrame) -> DataFrame:
        joined = x.alias("x").join(y, close).groupBy(F.col("x.a").alias("u"), F.col("y.a").alias("v"))
        return joined.agg(F.count("*").alias("c"), F.min(least).alias("least")).where("c >= least").select("u", "v")

    return [pairs(own) for own in _shares(few, parts, "a")]


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row, by links of Jaccard >= 0.75."""
    signed, placed = _placed(documents, id_col, text_col)
    doc_id = F.when(~F.col("unnamed"), F.col("doc_id")).alias("doc_id")
    named = signed.select(doc_id, F.col("n").alias("n_shingles"), "a", "b")
    out = named.join(placed.select("a", "b", "component_id"), ["a", "b"], "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"))


def _placed(documents: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    with settings(documents.sparkSession, SMALL_BATCHES):
        return _components_of_sets(documents, id_col, text_col)


def _components_of_sets(documents: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The rows with the digests (a, b) of their sets, and of every set that is not empty its
    component: (r, r2) tells components apart, also those of one least id."""
    spark = documents.sparkSession
    docs = _keyed(documents, id_col, text_col)
    buckets, excess = frequent_buckets(docs.select("text"))
    let_go(spark)

    # One row per document with the digests of its set (a, b), its bits and its prefix. Most of
    # it is prefixes, which go once the lists are made.
    with scratch(spark, docs.mapInPandas(_signed(buckets, excess), SIGNED), "jaccard-prefixes") as wide:
        signed = stored(spark, wide.select(*KEY, "a", "b", "n"), "jaccard-sets")
        rows, shingled = signed.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        most = max(MOVED, shingled // MOVED_SHARE)
        # A node is fetched by its least id; rows without one come last.
        known = wide.where("n > 0").groupBy("a").agg(F.min(F.struct("unnamed", "doc_id", "h", "n", "l", "bits")).alias("m"))
        nodes = _stored(spark, [known.select("a", *(f"m.{c}" for c in (*KEY, "n", "l", "bits")))], "jaccard-nodes")

        shared = _stored(spark, _entries(wide, min(LIST_PARTS, _parts_for(shingled, LISTED))), "jaccard-lists")
    # Rounds of stars: each list's first node, in an order that changes with the round, is
    # tried with the nodes of other components. Groups of near copies merge this way at a
    # cost in proportion to their size. Rounds go on while they are worth it.
    late, roots = spark.range(0).select(F.col("id").alias("u"), F.col("id").alias("v")), None
    for step in range(STAR_ROUNDS):
        tries = _stored(spark, [_star_pairs(shared, nodes, roots, step)], f"jaccard-stars-{step}-tries")
        tried = tries.count()
        parts = _parts_for(tried, max(ASKED, rows))
        close = _stored(spark, (_close(own, nodes) for own in _shares(tries, parts, "u")), f"jaccard-stars-{step}-pairs")
        found = _verified(docs, close, nodes, most, f"stars-{step}")
        linked = found.count()
        if linked * WORTH < tried or not tried:
            late = found  # few: merged with the links that come next
            break
        roots = merged(spark, roots, found)

    # Every pair of different components that shares enough of its prefixes: those in short
    # lists by a join, those in long lists family by family. A family is what long lists
    # connect; it is cut into blocks, and each pair of blocks is looked at by itself.
    parts = min(OPEN_PARTS, _parts_for(shared.count(), OPENED))
    open_ = _stored(spark, (_open(own, roots) for own in _shares(shared, parts, "t")), "jaccard-open")
    kinds = open_.groupBy("a").agg(F.max("long").alias("long"), F.max(1 - F.col("long")).alias("short"))
    kinds = stored(spark, kinds.join(nodes.select("a", "n", "l"), "a"), "jaccard-kinds")

    many = open_.where("long = 1")
    # A node goes to the least head of its lists, and their other heads do so too: far
    # fewer edges than entries, since the lists of a family share few heads.
    to = many.groupBy("a").agg(F.min("head").alias("v"), F.collect_set("head").alias("heads"))
    edges = to.select(F.explode(F.array_append("heads", F.col("a"))).alias("u"), "v").where("u <> v").distinct()
    families = components(spark, edges).select(F.col("node").alias("a"), F.col("root").alias("family"))
    members = many.groupBy("a").agg(F.array_sort(F.collect_set("t")).alias("tokens"))
    members = members.join(families, "a")
    sizes = many.join(families, "a").groupBy("family").agg(F.approx_count_distinct("a").alias("c"), F.count("*").alias("entries"))
    blocks = sizes.select("family", F.ceil(F.greatest(F.col("c") / BLOCK, F.col("entries") / BLOCK_TOKENS)).cast("int").alias("blocks"))
    members = members.join(blocks, "family").join(kinds.select("a", F.col("short").alias("more")), "a").join(nodes.select("a", "n", "l", "bits"), "a")
    members = _stored(spark, [members], "jaccard-families")
    parts = _family_parts(members, most)
    # A dense group has far more pairs than nodes, so nodes are first linked with the
    # nearest; what thereby shares a component is not looked at again.
    for step in range(FOREST_ROUNDS):
        near = _family_pairs(members, roots, NEAREST, parts)
        near = _stored(spark, (own.distinct() for own in near), f"jaccard-near-{step}")
        tried, found = near.count(), _verified(docs, near, nodes, most, f"near-{step}")
        roots, late = merged(spark, roots, late.unionByName(found)), late.limit(0)
        if found.count() * WORTH < tried or not tried:
            break

    few = open_.where("long = 0")
    # A node of a list of c meets (c - 1) / 2 others in it, on average.
    listed, met = few.agg(F.count("*"), F.sum((F.col("c") - 1) / 2)).first()
    few, of = few.join(kinds.select("a", "n", "l", F.col("long").alias("more")), "a"), _parts_for(met, max(PAIRED, PAIRED_SHARE * listed))
    if of > 1:
        few = _stored(spark, [few], "jaccard-short")
    rest = [_apart_pairs(own, roots) for own in _short_pairs(few, of)]
    rest += _family_pairs(members, roots, None, parts)
    rest = _stored(spark, (_close(own.distinct(), nodes) for own in rest), "jaccard-rest-found")
    # A dense group has far more pairs than nodes. While that is so, every node is tried
    # with its first and last partner, and pairs that thereby share a component go.
    rest = _stored(spark, [rest.distinct()], "jaccard-rest-pairs")  # a pair may share lists of both kinds
    members = rest.agg(F.approx_count_distinct("u")).first()[0]
    for step in range(FOREST_ROUNDS):
        if rest.count() <= DENSE * members:
            break
        ends = rest.groupBy("u").agg(F.array(F.min("v"), F.max("v")).alias("v")).select("u", F.explode("v").alias("v"))
        ends = stored(spark, ends.distinct(), f"jaccard-forest-{step}")
        roots = merged(spark, roots, late.unionByName(_verified(docs, ends, nodes, most, f"forest-{step}")))
        late = late.limit(0)
        rest = _apart_pairs(rest.join(ends, ["u", "v"], "left_anti"), roots)
        rest = stored(spark, rest, f"jaccard-rest-{step}")
    roots = merged(spark, roots, late.unionByName(_verified(docs, rest, nodes, most, "rest")))

    # Equal sets share a node, the smallest id names the component.
    doc_id = F.when(~F.col("unnamed"), F.col("doc_id"))
    nodes = signed.where("n > 0").groupBy("a", "b").agg(F.min(doc_id).alias("first"))
    rooted = nodes.join(roots.withColumnRenamed("node", "a"), "a", "left")
    # A node without links keeps to its own digest, so equal first halves do not meet.
    alone = F.when(F.col("root").isNull(), F.col("b"))
    smallest = rooted.groupBy(F.coalesce("root", "a").alias("r"), alone.alias("r2")).agg(F.min("first").alias("component_id"))
    placed = rooted.select("a", "b", F.coalesce("root", "a").alias("r"), alone.alias("r2"))
    same = (placed["r"] == smallest["r"]) & placed["r2"].eqNullSafe(smallest["r2"])
    return signed, placed.join(smallest, same).select("a", "b", placed["r"], placed["r2"], "component_id")


def one_of_each(documents: DataFrame) -> DataFrame:
    """One row for each group of near duplicates: the one with the smallest id, rows
    without one last; then by the hashes of its text and of the whole row.

    Texts without a word link with nothing: one row of each id stays, and every row
    without an id.
    """
    signed, placed = _placed(documents, "doc_id", "text")
    first = signed.where("n > 0").join(placed.select("a", "b", "r", "r2"), ["a", "b"])
    first = first.groupBy("r", "r2").agg(F.min(F.struct("unnamed", "doc_id", "h")).alias("m")).select("m.*")
    empty = signed.where("n = 0 AND NOT unnamed").groupBy("doc_id").agg(F.min("h").alias("h"))
    first = first.unionByName(empty.select(F.lit(False).alias("unnamed"), "doc_id", "h"))

    rows = documents.select(F.struct(*documents.columns).alias("row"), F.xxhash64(*documents.columns).alias("order"))
    key = F.coalesce(F.col("row.doc_id").cast("bigint"), F.lit(0)).alias("doc_id"), F.col("row.doc_id").isNull().alias("unnamed")
    worded = F.coalesce(F.col("row.text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("worded")
    rows = rows.select("row", "order", *key, F.xxhash64("row.text").alias("h"), worded)
    one = F.min_by("row", "order").alias("row"), F.min("order").alias("order")
    # Copies without an id share their key: they combine before they meet the others.
    loose = rows.where("unnamed AND worded").groupBy(*KEY).agg(*one)
    kept = rows.where("NOT unnamed").select("row", "order", *KEY).unionByName(loose.select("row", "order", *KEY))
    kept = kept.join(first, list(KEY), "left_semi").groupBy(*KEY).agg(*one)
    return kept.select("row").unionByName(rows.where("unnamed AND NOT worded").select("row")).select("row.*")
