"""Set-similarity join on word n-grams by vertical partitioning.

The global order of n-grams is the order of their fingerprints, and fragments are ranges of it. A set is cut into so many
that two sets above the threshold must agree on a whole non-empty fragment (pigeonhole over their largest possible
difference). Equal sets count as one, their representative. Documents that share a fragment meet in a star around the
first of them, in blocks. Parity bitmaps tell which members of a block may link. The sets of these are dealt out by fragment:
each (block, fragment) counts partial overlaps of all its pairs on its own, and a shuffle sums them for each pair. Each
document is first compared in the star with which it shares most keys; what these links do not connect is then compared in
every other star.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .storage import materialize, partitions
from .text import PACKED, PORTION, U64, FirstSeen, groups, hash_words, mix, ngrams, packed, portions, released, squeezed, unpacked, words

#: Members of a star whose bitmaps are compared with each other in one task, and members whose sets are.
WIDE, BLOCK = 4096, 256
#: Fragments of a block at least, and members of a fragment of its largest set at most, where overlaps are counted.
FRAGMENTS, FRAGMENT = 4, 2048
#: Columns of an incidence matrix.
COLUMNS = 4096


def shingle_set(items: list[bytes], n: int) -> np.ndarray:
    """Sorted distinct fingerprints of the n-word shingles, A-Z in lower case; of fewer words, one of their whole sequence."""
    h = hash_words(b" ".join(items).lower().split())
    if 0 < len(h) < n:
        return np.array([xxhash.xxh64_intdigest(h.tobytes(), seed=len(h))], dtype=U64)
    return np.unique(ngrams(h, n))


@lru_cache(maxsize=4096)
def _cut(g: int, percent: int) -> tuple[int, int]:
    """(fragments, empty ones allowed) of the sets of size class g: of these, as many more must agree as any set may leave empty."""
    ratio = percent / 100
    high = int(ratio ** -(g + 1) + 1e-6)
    apart = 2 * high * (100 - percent) // (100 + percent)
    if not apart:
        return 1, 0
    low = max(1.0, ratio ** (1 - g))
    spare = 0
    while spare < apart:
        empty = (apart + 2 + spare) * np.exp(-low / (apart + 2 + spare))
        if empty + 4 * np.sqrt(empty) <= spare + 1:
            break
        spare += 1 + spare // 16
    return apart + 2 + spare, spare + 1


def fragment_keys(s: np.ndarray, percent: int) -> np.ndarray:
    """One key for each non-empty fragment of a sorted set, for its own class of sizes and the next.

    Sizes fall in classes of ratio percent/100, so sets that link are in the same class or in neighbouring ones. Sets of up
    to `high` members that link differ in at most d = 2 * high * (100 - percent) / (100 + percent) members; of d + e + 1
    fragments at least e + 1 then agree, and one of those is not empty unless a set has more than e empty fragments. e is so
    large that hardly any set has; those few also give keys for their empty fragments.
    """
    n = len(s)
    if not n:
        return s
    size_class = int(np.floor(np.log(n) / -np.log(percent / 100) + 1e-9)) if percent < 100 else n
    sums = np.r_[U64(0), np.cumsum(mix(s + U64(7)))]
    out = []
    for g in (size_class, size_class + 1):
        count, allowed = _cut(g, percent) if percent < 100 else (1, 0)
        which = (((s >> U64(32)) * U64(count)) >> U64(32)).astype(np.int64)
        sizes = np.bincount(which, minlength=count)
        ends = np.cumsum(sizes)
        digest = sums[ends] - sums[ends - sizes]
        keys = mix(mix(digest + np.arange(count, dtype=U64)) + np.full(count, g, dtype=U64) * U64(0xC2B2AE3D27D4EB4F))
        out.append(keys[sizes > 0] if (sizes == 0).sum() <= allowed else keys)
    return np.unique(np.concatenate(out))


def overlaps(left: list[np.ndarray], right: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of all intersections of two blocks of sets; of one block with itself, but for its diagonal, if right is None."""
    sets = left + (right or [])
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    if right is None:
        shared = np.bincount(at, minlength=len(values)) > 1
    else:
        shared = (np.bincount(at[row < len(left)], minlength=len(values)) > 0) & (np.bincount(at[row >= len(left)], minlength=len(values)) > 0)
    used = shared[at]
    row, column = row[used], (np.cumsum(shared) - 1)[at[used]]
    total = np.zeros((len(left), len(sets) - len(left) if right is not None else len(left)), dtype=np.int64)
    for start in range(0, int(shared.sum()), COLUMNS):
        own = (column >= start) & (column < start + COLUMNS)
        part = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        part[row[own], column[own] - start] = 1
        total += np.rint(part[: len(left)] @ (part[len(left) :] if right is not None else part).T).astype(np.int64)
    return total


def spanning(pairs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of pairs, those that connect what no pair before them connects."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    out = []
    for x, y in pairs:
        p, q = find(x), find(y)
        if p != q:
            root[p] = q
            out.append((x, y))
    return out


def parity_bits(s: np.ndarray) -> bytes:
    """A bitmap of a set: a bit is the parity of the members it stands for; 1 to 2 bits a member, a power of two."""
    size = max(64, 1 << (len(s) - 1).bit_length())
    return np.packbits((np.bincount((s & U64(size - 1)).astype(np.int64), minlength=size) & 1).astype(np.uint8), bitorder="little").tobytes()


def _folded(maps: list[bytes], size: int) -> np.ndarray:
    """Bitmaps as rows of `size` bytes: halves of longer ones are added modulo 2, which gives the bitmap of that size."""
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(m, dtype=np.uint8).reshape(-1, size), axis=0) for m in maps]).view(U64)


def near_rows(a: pd.DataFrame, b: pd.DataFrame, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row of two lists (component, n, bits), the blocks of BLOCK rows of the other with one that it may link with and that is not known to be in its component.

    Bitmaps differ in at most as many bits as sets differ in members, so pairs that link always pass. Bitmaps of two sizes
    are compared at the smaller one.
    """
    n, m = a["n"].to_numpy(np.int64), b["n"].to_numpy(np.int64)
    own, other = a["component"].to_numpy(np.int64), b["component"].to_numpy(np.int64)
    near, met = (np.zeros((len(x), -(-len(y) // BLOCK)), dtype=bool) for x, y in ((a, b), (b, a)))
    sizes, widths = a["bits"].map(len).to_numpy(), b["bits"].map(len).to_numpy()
    for size in np.unique(sizes):
        rows = np.nonzero(sizes == size)[0]
        for width in np.unique(widths):
            columns = np.nonzero(widths == width)[0]
            left, right = (_folded(f["bits"].iloc[at].tolist(), min(size, width)) for f, at in ((a, rows), (b, columns)))
            for i, row in zip(rows.tolist(), left):
                apart = np.bitwise_count(right ^ row).sum(axis=1, dtype=np.int64)
                both = n[i] + m[columns]
                hit = ((100 + percent) * (both - apart) >= 2 * percent * both) & (100 * np.minimum(n[i], m[columns]) >= percent * np.maximum(n[i], m[columns])) & (other[columns] != own[i])
                if hit.any():
                    near[i, columns[hit] // BLOCK] = True
                    met[columns[hit], i // BLOCK] = True
    return near, met


#: Bytes of a key within its bucket. Keys that agree by chance only add candidates, which are verified.
KEY_BYTES = 5


def shortened(frame: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """packed() rows for the shuffle: keys without what their bucket tells, in KEY_BYTES bytes; docs as runs (documents, then lengths)."""
    keys, docs = [], []
    for k, d in zip(frame["keys"], frame["docs"]):
        rest = np.frombuffer(k, dtype=U64) // U64(buckets)
        keys.append(rest.view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes())
        d = np.frombuffer(d, dtype=np.int64)
        at = np.r_[0, np.nonzero(np.diff(d))[0] + 1]
        docs.append(d[at].tobytes() + np.diff(np.r_[at, len(d)]).astype(np.uint32).tobytes())
    return frame.assign(keys=keys, docs=docs)


def lengthened(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """shortened() rows with keys and docs of eight bytes again."""
    for frame in frames:
        keys, docs = [], []
        for k, d in zip(frame["keys"], frame["docs"]):
            wide = np.zeros((len(k) // KEY_BYTES, 8), dtype=np.uint8)
            wide[:, :KEY_BYTES] = np.frombuffer(k, dtype=np.uint8).reshape(-1, KEY_BYTES)
            keys.append(wide.tobytes())
            runs = len(d) // 12
            docs.append(np.repeat(np.frombuffer(d, dtype=np.int64, count=runs), np.frombuffer(d, dtype=np.uint32, offset=8 * runs)).tobytes())
        yield frame.assign(keys=keys, docs=docs)


def shingle_table(docs: DataFrame, n: int, percent: int, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, n_shingles, signature, keys, bits) of each row: its set's size, a 128-bit signature of the set, its fragment keys and parity bits."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in portions(frames, "text"):
            rows = []
            for i, text in zip(frame["doc_id"], frame["text"]):
                s = shingle_set(words(text), n)
                rows.append((i, len(s), *((xxhash.xxh3_128_digest(s.tobytes()), fragment_keys(s, percent).tobytes(), parity_bits(s)) if len(s) else (None, None, None))))
            yield pd.DataFrame(rows, columns=["doc_id", "n_shingles", "signature", "keys", "bits"])

    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).where("doc_id IS NOT NULL")
    return source.mapInPandas(run, "doc_id long, n_shingles long, signature binary, keys binary, bits binary")


#: Words of 64 marks by which the ids that met are told from others; a broadcast has so many rows at most, whatever the input.
WORDS = 1 << 20


def _marked(rows: DataFrame, members: DataFrame) -> DataFrame:
    """rows (doc_id and others) whose id may be among members (doc_id): all that are, and as many others as share a mark with one.

    Members set marks by their hashed ids. Few others pass up to some ten million members; with far more all rows do, and the
    join that follows does the work alone.
    """
    hashed = F.xxhash64("doc_id")
    place = {"word": F.pmod(hashed, F.lit(WORDS)), "mark": F.pmod(F.shiftright(hashed, 32), F.lit(64)).cast("int")}
    marks = members.withColumns(place).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, mark)")).alias("marks"))
    return rows.withColumns(place).join(F.broadcast(marks), "word").where("getbit(marks, mark) = 1").select(*rows.columns)


def similarity_links(docs: DataFrame, table: DataFrame, classes: DataFrame, n: int, percent: int, id_column: str, text_column: str) -> DataFrame:
    """(a, b): links that connect what links connect among the representatives of different sets, of classes (signature, doc_id) of table, the shingle_table() of docs.

    Rows post their keys from where they lie; equal sets post one code, a hash of the signature, so a set never meets its
    copies, and only the few codes that met are exchanged for representatives. Should two sets have one code, both are
    compared with what either of them met.
    """
    spark = docs.sparkSession
    parts = partitions(spark)
    buckets = 4 * parts
    code = F.xxhash64("signature")

    def post(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for frame in portions(frames, "keys"):
            # Of copies, each task posts one; it has as many codes as its part of the table has rows at most.
            frame = frame[~frame["code"].isin(seen) & ~frame["code"].duplicated()]
            if not len(frame):
                continue
            seen.update(frame["code"].tolist())
            rows = packed([np.frombuffer(k, dtype=U64) for k in frame["keys"]], frame["code"].tolist(), buckets)
            # Sets come in one order to all buckets, so that most of a group's keys name the same pivot.
            yield shortened(rows.assign(lo=frame["doc_id"].min()), buckets)

    def meet(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, bucket = FirstSeen(), None
        for b, keys, ids in unpacked(lengthened(frames)):
            if b != bucket:
                seen, bucket = FirstSeen(), b
            _, owner, member = seen.feed(keys, ids)
            if len(owner):
                pairs, shared = np.unique(np.stack([owner, member], axis=1), axis=0, return_counts=True)
                yield pd.DataFrame({"first": pairs[:, 0], "member": pairs[:, 1], "shared": shared})

    posted = table.where("signature IS NOT NULL").select("doc_id", code.alias("code"), "keys").mapInPandas(post, PACKED)
    posted = posted.repartition(parts, "bucket").sortWithinPartitions("bucket", "lo", F.xxhash64("keys"))
    met = posted.mapInPandas(meet, "first long, member long, shared long").groupBy("first", "member").agg(F.sum("shared").alias("shared"))
    met = met.join(classes.select(code.alias("first"), F.col("doc_id").alias("pivot")), "first").join(classes.select(code.alias("member"), "doc_id"), "member")
    stars = materialize(met.where("pivot <> doc_id").groupBy("pivot", "doc_id").agg(F.sum("shared").alias("shared")), "stars")
    members = stars.select(F.explode(F.array("pivot", "doc_id")).alias("doc_id")).distinct()
    bits = table.select("doc_id", "signature", F.col("n_shingles").alias("n"), "bits").where("signature IS NOT NULL")
    bits = _marked(bits, members).join(members, "doc_id", "left_semi")
    bits = materialize(bits.dropDuplicates(["doc_id", "signature"]).drop("signature"), "bits")
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).where("text IS NOT NULL")
    texts = _marked(texts, members).select("doc_id", squeezed("text").alias("z"))
    # A repeated id may have several texts: each of them is compared.
    texts = materialize(texts.join(members, "doc_id", "left_semi").dropDuplicates(["doc_id", "z"]), "texts")

    def links(placed: DataFrame, name: str) -> DataFrame:
        near = materialize(_near(placed, bits, percent, parts), f"near-{name}")
        return materialize(_exact(near, texts, n, percent, parts), name)

    first = links(_closest(stars), "links")
    return first.unionByName(links(_across(stars, components(first)), "across"))


#: A place is a block of a star (column -1), or a pair of blocks (column, block); its rows are compared with each other, or those of side 0 with those of side 1.
PLACE = ["pivot", "column", "block"]
#: A part of a place is a pair of blocks of BLOCK of its rows, or one block, if both are the same.
PART = [*PLACE, "low", "high"]
_PART = "pivot long, column int, block int, low int, high int"


def _closest(stars: DataFrame) -> DataFrame:
    """Places for each document in the star of the pivot with which it shares most keys, in blocks; the pivot is in each block."""
    own = materialize(stars.groupBy("doc_id").agg(F.max_by("pivot", F.struct("shared", -F.col("pivot"))).alias("pivot")), "closest")
    sized = own.groupBy("pivot").agg(F.ceil((F.count("*") + 1) / WIDE).cast("int").alias("blocks"))
    members = own.join(sized, "pivot").select("pivot", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int").alias("block"), "doc_id")
    pivots = sized.select("pivot", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("pivot").alias("doc_id"))
    return members.unionByName(pivots).select("pivot", F.lit(-1).alias("column"), "block", F.lit(0).alias("side"), "doc_id", F.col("doc_id").alias("component"))


def _across(stars: DataFrame, tied: DataFrame) -> DataFrame:
    """Places for stars with members that are not known to be in the component of the star's pivot.

    Those members are dealt into columns; each column meets every block of the star, pivot included. A star of one block is
    compared as it is. If all are tied, no row is made here.
    """
    named = stars.select("pivot", "doc_id").join(tied.select(F.col("id").alias("doc_id"), F.col("component").alias("own")), "doc_id", "left")
    named = named.join(tied.select(F.col("id").alias("pivot"), F.col("component").alias("centre")), "pivot", "left")
    named = materialize(named.select("pivot", "doc_id", F.coalesce("own", "doc_id").alias("component"), F.coalesce("centre", "pivot").alias("centre")), "named")
    loose = F.col("component") != F.col("centre")
    sized = named.groupBy("pivot").agg(
        F.first("centre").alias("component"),
        F.ceil((F.count("*") + 1) / WIDE).cast("int").alias("blocks"),
        F.ceil(F.count_if(loose) / WIDE).cast("int").alias("columns"),
    )
    sized = materialize(sized.where("columns > 0"), "sized")
    counts = sized.select("pivot", "blocks", "columns")
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    every = F.explode(F.when(F.col("blocks") == 1, F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("columns") - 1))).alias("column")
    column = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("columns")).cast("int").alias("column")
    block = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int").alias("block")
    left = named.where(loose).join(counts.where("blocks > 1"), "pivot").select("pivot", column, each, F.lit(0).alias("side"), "doc_id", "component")
    members = named.drop("centre").unionByName(sized.select("pivot", F.col("pivot").alias("doc_id"), "component")).join(counts, "pivot")
    right = members.select("pivot", every, block, F.lit(1).alias("side"), "doc_id", "component")
    return left.unionByName(right)


def _sides(frames: Iterator[pd.DataFrame], keys: list[str], within: Callable[[pd.DataFrame], bool]) -> Iterator[tuple[pd.DataFrame, pd.DataFrame]]:
    """The two sides of each group, with at least two rows; both are the same where `within` tells that the group is compared with itself."""
    for group in groups(frames, keys):
        if within(group):
            if len(group) > 1:
                yield group, group
        else:
            side = group["side"].to_numpy()
            if 0 < side.sum() < len(side):
                yield group[side == 0], group[side == 1]


def _near(placed: DataFrame, bits: DataFrame, percent: int, parts: int) -> DataFrame:
    """The rows of placed (PLACE, side, doc_id, component) whose bitmap comes near that of a row of their place in another component: PART, side, doc_id, and cuts, the fragments of the part."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for a, b in _sides(frames, PLACE, lambda g: g["column"].iloc[0] < 0):
            near, met = near_rows(a, b, percent)
            size = max(a["n"].max(), b["n"].max())
            for low, high in np.argwhere([[near[k : k + BLOCK, j].any() for j in range(near.shape[1])] for k in range(0, len(a), BLOCK)]).tolist():
                same = a is b and low == high
                if a is b and low > high:
                    continue
                left, right = low * BLOCK + np.nonzero(near[low * BLOCK : (low + 1) * BLOCK, high])[0], high * BLOCK + np.nonzero(met[high * BLOCK : (high + 1) * BLOCK, low])[0]
                found = a.iloc[np.union1d(left, right)].assign(side=0) if same else pd.concat([a.iloc[left].assign(side=0), b.iloc[right].assign(side=1)])
                yield found.assign(low=low, high=high, cuts=max(FRAGMENTS, -(-int(size) // FRAGMENT)))[[*PART, "side", "doc_id", "cuts"]]

    dealt = placed.join(bits, "doc_id").repartition(parts, *PLACE).sortWithinPartitions(*PLACE, "side", "doc_id")
    return dealt.select(*PLACE, "side", "doc_id", "component", "n", "bits").mapInPandas(run, f"{_PART}, side int, doc_id long, cuts int")


def _alone(group: pd.DataFrame) -> bool:
    return group["column"].iloc[0] < 0 and group["low"].iloc[0] == group["high"].iloc[0]


def _exact(near: DataFrame, texts: DataFrame, n: int, percent: int, parts: int) -> DataFrame:
    """(a, b): a spanning forest of the links in each part, of near (PART, side, doc_id, cuts) and texts (doc_id, z).

    Sets go to their parts fragment by fragment. A (part, fragment) counts the partial overlaps of all its pairs, as one
    matrix; the matrices of a part are summed, and the sums compared with the threshold.
    """
    places = near.groupBy("doc_id").agg(F.collect_set(F.struct(*PART, "side", "cuts")).alias("places"))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in portions(frames, "z", growth=3):
            rows, size = [], 0
            for doc, z, found in zip(frame["doc_id"].tolist(), released(frame["z"]), frame["places"]):
                s = shingle_set(z.split(), n)
                mark = int(s[:1].view(np.int64).sum())
                for p in found:
                    ends = np.searchsorted(((s >> U64(32)) * U64(p["cuts"])) >> U64(32), np.arange(p["cuts"] + 1, dtype=U64))
                    rows += [(*(p[c] for c in PART), k, p["side"], doc, mark, len(s), s[a:b].tobytes()) for k, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist()))]
                    size += 8 * len(s)
                    if size > PORTION:
                        yield pd.DataFrame(rows, columns=names)
                        rows, size = [], 0
            yield pd.DataFrame(rows, columns=names)

    names = [*PART, "fragment", "side", "doc_id", "mark", "n", "part"]

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for a, b in _sides(frames, [*PART, "fragment"], _alone):
            left = [np.frombuffer(x, dtype=U64) for x in a["part"]]
            both = overlaps(left) if a is b else overlaps(left, [np.frombuffer(x, dtype=U64) for x in b["part"]])
            if both.any():
                ids = [f[c].to_numpy(np.int64).tobytes() for f in (a, b) for c in ("doc_id", "n")]
                yield pd.DataFrame([(*(int(a[c].iloc[0]) for c in PART), a is b, squeeze(b"".join(ids)), len(a), squeeze(both.astype(np.uint32).tobytes()))], columns=[*PART, "same", "ids", "height", "counts"])

    def summed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in groups(frames, PART):
            parts_ = [np.frombuffer(x, dtype=np.uint32) for x in released(group["counts"])]
            height, same = int(group["height"].iloc[0]), bool(group["same"].iloc[0])
            both = np.sum(parts_, axis=0, dtype=np.int64).reshape(height, -1)
            width = both.shape[1]
            ids = np.frombuffer(released(group["ids"].iloc[:1])[0], dtype=np.int64)
            left, size, right, other = np.split(ids, [height, 2 * height, 2 * height + width])
            linked = 100 * both >= percent * (size[:, None] + other[None, :] - both)
            i, j = np.nonzero(np.triu(linked, 1) if same else linked)
            yield pd.DataFrame(spanning(zip(left[i].tolist(), right[j].tolist())), columns=["a", "b"], dtype=np.int64)

    dealt = places.join(texts, "doc_id").select("doc_id", "z", "places").mapInPandas(cut, f"{_PART}, fragment int, side int, doc_id long, mark long, n long, part binary")
    dealt = dealt.repartition(parts, *PART, "fragment").sortWithinPartitions(*PART, "fragment", "side", "doc_id", "mark")
    partial = dealt.mapInPandas(count, f"{_PART}, same boolean, ids binary, height int, counts binary")
    return partial.repartition(parts, *PART).sortWithinPartitions(*PART).mapInPandas(summed, "a long, b long").where("a <> b")


def ngram_jaccard_join(docs: DataFrame, n: int = 3, percent: int = 90, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) for each row of docs.

    Two texts link when 100 * intersection >= percent * union of their sets of n-word shingles. component_id is the
    smallest doc_id reachable by links, the row's own if none. n_links counts the links that were used to connect the
    document (a spanning set; equal texts count one to their representative).

    Null and empty texts have n_shingles 0 and link with nothing. Rows whose id is null cannot be named and are left out.
    Rows that repeat an id are one document, which links by any of its texts; each has its own result row. Other columns are
    ignored. Any percent from 1 to 100 is exact.
    """
    table = materialize(shingle_table(docs, n, percent, id_column, text_column), "shingles")
    classes = table.where("signature IS NOT NULL").groupBy("signature").agg(F.min("doc_id").alias("doc_id"))
    classes = materialize(classes, "classes")
    links = similarity_links(docs, table, classes, n, percent, id_column, text_column)
    names = classes.select("signature", F.col("doc_id").alias("representative"))
    # An id of several texts ties their representatives.
    several = table.groupBy("doc_id").agg(F.min("signature").alias("low"), F.max("signature").alias("high")).where("low <> high").select("doc_id")
    same = table.join(several, "doc_id", "left_semi").join(names, "signature").select(F.col("doc_id").alias("a"), F.col("representative").alias("b")).where("a <> b")
    links = materialize(links.unionByName(same), "alllinks")
    tied = components(links)
    degree = links.select(F.explode(F.array("a", "b")).alias("doc_id")).groupBy("doc_id").agg(F.count("*").alias("degree"))
    names = names.join(tied.select(F.col("id").alias("representative"), "component"), "representative", "left").join(degree.withColumnRenamed("doc_id", "representative"), "representative", "left")
    names = materialize(names, "names")
    out = table.drop("keys", "bits").join(names, "signature", "left")
    return out.select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "representative", "doc_id").alias("component_id"),
        (F.when(F.col("representative") == F.col("doc_id"), F.coalesce("degree", F.lit(0))).when(F.col("representative").isNull(), 0).otherwise(1)).cast("long").alias("n_links"),
    )
