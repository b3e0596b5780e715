"""N-gram Jaccard join by prefix filters under several global token orders.

A text is the set of its five-word shingles; two texts link if their Jaccard similarity is at
least 0.75. With tokens in any one global order, linked sets share a token within their first
``n - ceil(0.75 n) + 1`` tokens. The orders used here put rare tokens first and differ among
tokens of equal frequency, so a candidate must pass the filter under each of them.

1. Texts of one word sequence form a class; only classes go on.
2. Tokens are dealt into buckets, as packed arrays of some thousand classes, and counted. Tokens
   that occur once come first in every order and can link nothing; all others return to their
   pack with their count. (A class with copies in several packs counts once in each.) These shared
   tokens hold every intersection, so texts are not read again.
3. The prefixes under the first order are posting lists. Each list has a pivot; every class is
   compared with the pivot of its lists, which merges groups of near copies by one link each.
4. What this left apart is compared in blocks of about 256 classes, for every pair of blocks that
   meet in a posting list. Classes linked to one pivot are not compared again. Inside a pair of
   blocks the filters of all orders are intersected, survivors are verified, and a spanning
   forest of the links is passed on: never all pairs of a group.
5. Components of the links, carried back to the documents.

Hashes have 64 bits. A token travels as its low 48 bits, its bucket being a number of its high bits:
with 2 ** 16 buckets or more it is whole again, with fewer it has 48 bits beside the bucket's.

Defined cases: null and empty texts, and texts of white space, have no shingles and stay alone;
repeated rows are one class; the component is the smallest non-null doc_id (null if there is
none); very long texts are whole sets; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddrow.llm.common import ids_and_texts, map_batches, packed, unpacked
from oddrow.llm.components import connected
from oddrow.llm.shingles import ShingleSet, mix, shingle_sets
from oddrow.sources.storage import Scratch

#: Similarity as a fraction.
SHARE, OF = 75, 100
ORDERS = 3
#: Tokens per bucket and classes per block, on average: they bound the memory of one task.
BUCKET_TOKENS = 2_000_000
BLOCK = 256
#: Tokens and classes of one pack; places in a pack are 16-bit numbers.
PACKED_TOKENS = 1 << 20
PACKED_CLASSES = 60_000
#: A pack has as many tokens for each bucket at least, so that its rows grow with its tokens.
LEAST_DEALT = 16
TOKEN_BITS = 48
SEEN_KEYS = 100_000
COARSE_SLOTS = 1 << 22
TEXTS_AT_ONCE = 256

KEYS = "doc_id long, key long, n_shingles long, mark long"
# A pack's tokens in one bucket; or, without tokens, the classes of the pack.
PACKED = "bucket int, pack long, places binary, low binary, high binary, keys binary, sizes binary"
RETURNED = "pack long, places binary, tokens binary, df binary, keys binary, sizes binary"
SETS = "key long, n int, tokens binary, df binary, prefix array<long>"
EDGES = "a long, b long"


def _texts(
    batches: Iterable[pa.RecordBatch],
) -> Iterator[tuple[pa.RecordBatch, list[ShingleSet]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
            few = batch.slice(at, TEXTS_AT_ONCE)
            yield few, shingle_sets(few.column("text").to_pylist())


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _key_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for few, sets in _texts(batches):
        keys = [None if s.key is None else _signed(s.key) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                few.column("doc_id"),
                pa.array(keys, pa.int64()),
                pa.array([len(s.items) for s in sets], pa.int64()),
                few.column("mark"),
            ],
            names=["doc_id", "key", "n_shingles", "mark"],
        )


# ------------------------------------------------------------------ counting of tokens


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of equal values."""
    if not len(values):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    return starts, np.diff(np.r_[starts, len(values)])


def _packed(parts: list[ShingleSet], bits: int, pack: int) -> pa.RecordBatch:
    """One row per bucket with the tokens of several classes, and one row with the classes."""
    tokens = np.concatenate([p.items for p in parts])
    places = np.repeat(np.arange(len(parts), dtype=np.uint16), [len(p.items) for p in parts])
    dealt = _bucket(tokens, bits)
    order = np.argsort(dealt, kind="stable")
    tokens, places, dealt = tokens[order], places[order], dealt[order]
    rows: dict[str, list] = {c.split()[0]: [] for c in PACKED.split(", ")}
    for start, length in zip(*_runs(dealt)):
        inside = slice(start, start + length)
        rows["bucket"].append(int(dealt[start]))
        rows["places"].append(places[inside].tobytes())
        rows["low"].append(tokens[inside].astype(np.uint32).tobytes())
        rows["high"].append((tokens[inside] >> np.uint64(32)).astype(np.uint16).tobytes())
    rows["bucket"].append(pack % (1 << bits))
    for column in ("places", "low", "high"):
        rows[column].append(b"")
    listed = len(rows["bucket"]) - 1
    rows["keys"] = [b""] * listed + [np.array([p.key for p in parts], np.uint64).tobytes()]
    rows["sizes"] = [b""] * listed + [np.array([len(p.items) for p in parts], np.uint32).tobytes()]
    rows["pack"] = [pack] * (listed + 1)
    return _batch(rows)


def _batch(rows: dict[str, list]) -> pa.RecordBatch:
    kinds = {"bucket": pa.int32(), "pack": pa.int64()}
    arrays = [pa.array(v, kinds.get(c, pa.binary())) for c, v in rows.items()]
    return pa.RecordBatch.from_arrays(arrays, names=list(rows))


def bucket_bits(tokens: int) -> int:
    """Bits of a bucket's number, so that a bucket has ``BUCKET_TOKENS`` tokens at most on
    average, however many there are."""
    return max(0, -(-tokens // BUCKET_TOKENS) - 1).bit_length()


def _bucket(tokens: np.ndarray, bits: int) -> np.ndarray:
    """The high bits of tokens."""
    if not bits:
        return np.zeros(len(tokens), np.int32)
    return (tokens >> np.uint64(64 - bits)).astype(np.int32)


def _pack_tokens(bits: int):
    most = max(PACKED_TOKENS, LEAST_DEALT << bits)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task that is run again makes the same packs from the same rows.
        pack = TaskContext.get().partitionId() << 32
        seen: set[int] = set()
        parts: list[ShingleSet] = []
        held = 0
        for _, sets in _texts(batches):
            for made in sets:
                if made.key is None or made.key in seen:
                    continue
                seen.add(made.key)
                parts.append(made)
                held += len(made.items)
                if held >= most or len(parts) >= PACKED_CLASSES:
                    yield _packed(parts, bits, pack)
                    pack, parts, held = pack + 1, [], 0
            if len(seen) > SEEN_KEYS:
                seen.clear()
        if parts:
            yield _packed(parts, bits, pack)

    return run


def _joined(table: pa.Table, column: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), kind)


def _share_tokens(bits: int):
    """Count one bucket's tokens; return those that occur twice or more to their packs."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _shared(key[0].as_py() >> max(0, bits - 16), table)

    return run


def _shared(high: int, table: pa.Table) -> pa.Table:
    """``high`` are the bits of the bucket's tokens above the low 48."""
    tokens = _joined(table, "low", np.uint32).astype(np.uint64)
    tokens |= _joined(table, "high", np.uint16).astype(np.uint64) << np.uint64(32)
    places = _joined(table, "places", np.uint16)
    lengths = np.array([len(b) for b in table.column("places").to_pylist()], np.int64) // 2
    packs = np.repeat(table.column("pack").to_numpy(), lengths)
    # Most tokens occur once; a coarse count leaves few of those for the sort.
    slots = (tokens % np.uint64(COARSE_SLOTS)).astype(np.int64)
    maybe = np.bincount(slots, minlength=COARSE_SLOTS)[slots] > 1
    tokens, places, packs = tokens[maybe], places[maybe], packs[maybe]
    order = np.argsort(tokens, kind="stable")
    tokens, places, packs = tokens[order], places[order], packs[order]
    _, runs = _runs(tokens)
    df = np.repeat(runs, runs)
    shared = df > 1
    tokens = tokens[shared] | np.uint64(high) << np.uint64(TOKEN_BITS)
    places, packs = places[shared], packs[shared]
    df = np.minimum(df[shared], 0xFFFF).astype(np.uint16)
    order = np.argsort(packs, kind="stable")
    tokens, places, packs, df = tokens[order], places[order], packs[order], df[order]
    rows: dict[str, list] = {c.split()[0]: [] for c in RETURNED.split(", ")}
    for start, length in zip(*_runs(packs)):
        inside = slice(start, start + length)
        rows["pack"].append(int(packs[start]))
        rows["places"].append(places[inside].tobytes())
        rows["tokens"].append(tokens[inside].tobytes())
        rows["df"].append(df[inside].tobytes())
        rows["keys"].append(b"")
        rows["sizes"].append(b"")
    for row in table.select(["pack", "keys", "sizes"]).to_pylist():
        if row["keys"]:
            for column in RETURNED.split(", "):
                name = column.split()[0]
                rows[name].append(row.get(name, b""))
    return pa.Table.from_batches([_batch(rows)])


# ------------------------------------------------------------------ prefixes


def overlap_needed(n: int) -> int:
    """Fewest common tokens of a set of ``n`` with a set that it links to."""
    return -(-SHARE * n // OF)


def prefix(tokens: np.ndarray, df: np.ndarray, n: int, order: int) -> np.ndarray:
    """The shared tokens among the first ones of a set of ``n``, under one order.

    Tokens come by frequency, then by a hash that differs from order to order. The ``n -
    len(tokens)`` tokens of no other class come before all of these.
    """
    length = n - overlap_needed(n) + 1 - (n - len(tokens))
    if length <= 0:
        return tokens[:0]
    ties = mix(tokens ^ np.uint64(order * 0x632BE59BD9B4E019 & (1 << 64) - 1))
    return tokens[np.lexsort((ties, df))[:length]]


def _gather_sets(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The shared tokens of each class of a pack, with its prefix under the first order."""
    places = _joined(table, "places", np.uint16)
    tokens = _joined(table, "tokens", np.uint64)
    df = _joined(table, "df", np.uint16)
    keys = _joined(table, "keys", np.uint64)
    sizes = _joined(table, "sizes", np.uint32)
    order = np.lexsort((tokens, places))
    places, tokens, df = places[order], tokens[order], df[order]
    rows: dict[str, list] = {c.split()[0]: [] for c in SETS.split(", ")}
    for start, length in zip(*_runs(places)):
        inside = slice(start, start + length)
        place = int(places[start])
        n = int(sizes[place])
        first = prefix(tokens[inside], df[inside], n, 1)
        if len(first):
            rows["key"].append(_signed(int(keys[place])))
            rows["n"].append(n)
            rows["tokens"].append(tokens[inside].tobytes())
            rows["df"].append(df[inside].tobytes())
            rows["prefix"].append(first.view(np.int64))
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
    return pa.table({c: pa.array(v, k) for (c, v), k in zip(rows.items(), kinds)})


# ------------------------------------------------------------------ comparing


class _Member:
    """A class inside a comparison."""

    __slots__ = ("key", "n", "tokens", "df", "group")

    def __init__(self, row: dict, group: object = None) -> None:
        self.key, self.n, self.group = row["key"], row["n"], group
        self.tokens = np.frombuffer(row["tokens"], np.uint64)
        self.df = np.frombuffer(row["df"], np.uint16)


def _meeting(left: list[_Member], right: list[_Member], order: int) -> np.ndarray:
    """Which pairs share a prefix token under one order."""
    both = [*left, *right]
    firsts = [prefix(m.tokens, m.df, m.n, order) for m in both]
    tokens = np.concatenate(firsts)
    owner = np.repeat(np.arange(len(both)), [len(f) for f in firsts])
    by_token = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[by_token], owner[by_token]
    meets = np.zeros((len(left), len(right)), bool)
    starts, lengths = _runs(tokens)
    for start, length in zip(starts[lengths > 1], lengths[lengths > 1]):
        owners = owner[start : start + length]
        split = np.searchsorted(owners, len(left))
        if 0 < split < length:
            meets[np.ix_(owners[:split], owners[split:] - len(left))] = True
    return meets


def linked_pairs(left: list[_Member], right: list[_Member], wanted: np.ndarray) -> np.ndarray:
    """Index pairs of ``wanted`` that pass the filters of all orders and link."""
    n_left = np.array([m.n for m in left], np.int64)[:, None]
    n_right = np.array([m.n for m in right], np.int64)[None, :]
    candidates = (
        wanted
        & (OF * np.minimum(n_left, n_right) >= SHARE * np.maximum(n_left, n_right))
    )
    for order in range(1, ORDERS + 1):
        if not candidates.any():
            return np.empty((0, 2), np.int64)
        candidates &= _meeting(left, right, order)
    rows, columns = np.nonzero(candidates)
    if not len(rows):
        return np.empty((0, 2), np.int64)
    common = _overlaps(left, right, np.unique(rows), np.unique(columns))
    found = common[rows, columns]
    union = n_left[rows, 0] + n_right[0, columns] - found
    return np.stack([rows, columns], 1)[OF * found >= SHARE * union]


def _overlaps(
    left: list[_Member], right: list[_Member], rows: np.ndarray, columns: np.ndarray
) -> np.ndarray:
    """Sizes of the intersections, by products of 0-1 matrices over slices of the tokens."""
    members = [left[i] for i in rows] + [right[j] for j in columns]
    owner = np.repeat(np.arange(len(members)), [len(m.tokens) for m in members])
    _, token = np.unique(np.concatenate([m.tokens for m in members]), return_inverse=True)
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    common = np.zeros((len(left), len(right)), np.int64)
    width = 4096
    for first in range(0, int(token[-1]) + 1, width):
        start, end = np.searchsorted(token, (first, first + width))
        held = np.zeros((len(members), width), np.float32)
        held[owner[start:end], token[start:end] - first] = 1
        product = held[: len(rows)] @ held[len(rows) :].T
        common[np.ix_(rows, columns)] += product.astype(np.int64)
    return common


def _forest(left: list[_Member], right: list[_Member], pairs: np.ndarray) -> list[tuple]:
    """Links that join what no earlier link or common pivot has joined."""
    up: dict = {}

    def top(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    edges = []
    for i, j in pairs:
        a, b = left[i], right[j]
        ends = [top(("group", m.group) if m.group is not None else m.key) for m in (a, b)]
        if ends[0] != ends[1]:
            up[ends[0]] = ends[1]
            edges.append((a.key, b.key))
    return edges


def _edge_table(edges: list[tuple]) -> pa.Table:
    return pa.table(
        {
            "a": pa.array([e[0] for e in edges], pa.int64()),
            "b": pa.array([e[1] for e in edges], pa.int64()),
        }
    )


def _compare_with_pivot(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a class (key, n, ...) and its pivot (p_key, p_n, ...)."""
    for batch in batches:
        edges = []
        for row in batch.to_pylist():
            one = _Member(row)
            other = _Member({c: row[f"p_{c}"] for c in ("key", "n", "tokens", "df")})
            if len(linked_pairs([one], [other], np.ones((1, 1), bool))):
                edges.append((one.key, other.key))
        yield from _edge_table(edges).to_batches()


def _compare_blocks(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One pair of blocks, or one block with itself: the links that join something."""
    sides: dict[int, list[_Member]] = {0: [], 1: []}
    alone = bool(table.column("alone")[0].as_py())
    for row in sorted(table.to_pylist(), key=lambda r: (r["side"], r["key"])):
        sides[row["side"]].append(_Member(row, row["pivot"] if row["linked"] else None))
    left, right = sides[0], sides[0] if alone else sides[1]
    if not left or not right:
        return _edge_table([])
    wanted = np.array(
        [[a.group is None or a.group != b.group for b in right] for a in left], bool
    )
    if alone:
        wanted &= np.triu(np.ones(wanted.shape, bool), 1)
    return _edge_table(_forest(left, right, linked_pairs(left, right, wanted)))


# ------------------------------------------------------------------ the join


def text_keys(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n_shingles, mark): class, size of the set, and a hash of the text."""
    texts = ids_and_texts(docs).withColumn("mark", F.xxhash64("text"))
    return map_batches(texts, _key_batches, KEYS)


def shared_sets(docs: DataFrame, shingles: int) -> DataFrame:
    """Classes that may link, with their shared tokens and first prefix."""
    bits = bucket_bits(shingles)
    packed_tokens = map_batches(ids_and_texts(docs), _pack_tokens(bits), PACKED)
    returned = packed_tokens.groupBy("bucket").applyInArrow(_share_tokens(bits), RETURNED)
    sets = returned.groupBy("pack").applyInArrow(_gather_sets, SETS)
    # A class of several packs comes out of each with the same tokens and counts.
    return sets.dropDuplicates(["key"])


def _prefixed(sets: DataFrame) -> DataFrame:
    return sets.select(*(F.col(c).alias(f"p_{c}") for c in ("key", "n", "tokens", "df")))


def links(sets: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b): links of classes that connect whatever any links connect."""
    postings = sets.select("key", F.explode("prefix").alias("token"))
    ranked = F.struct(F.xxhash64("key").alias("hash"), "key")
    lists = postings.groupBy("token").agg(
        F.min(ranked).alias("pivot"), F.count("*").alias("members")
    )
    met = scratch.keep(
        postings.join(lists.filter("members > 1"), "token").select("key", "token", "pivot"),
        "postings",
    )
    pivots = scratch.keep(
        met.groupBy("key").agg(F.min("pivot")["key"].alias("pivot")), "pivots"
    )
    body = sets.drop("prefix")
    compared = (
        pivots.filter("key <> pivot")
        .join(body, "key")
        .join(_prefixed(sets), F.col("pivot") == F.col("p_key"))
        .drop("pivot")
    )
    near = scratch.keep(map_batches(compared, _compare_with_pivot, EDGES), "pivot-links")

    joined = near.select(F.col("a").alias("key"), F.lit(True).alias("hit"))
    members = pivots.join(joined, "key", "left").select(
        "key",
        "pivot",
        (F.col("hit").isNotNull() | (F.col("key") == F.col("pivot"))).alias("linked"),
    )
    crowds = members.groupBy("pivot", "linked").agg(
        F.ceil(F.count("*") / F.lit(BLOCK)).alias("chunks")
    )
    chunk = F.pmod(F.xxhash64(F.lit(1), "key"), F.col("chunks"))
    members = scratch.keep(
        members.join(crowds, ["pivot", "linked"]).select(
            "key", "pivot", "linked", F.xxhash64("pivot", "linked", chunk).alias("block")
        ),
        "members",
    )
    units = scratch.keep(_units(met, members), "units")
    sides = [
        F.struct(F.lit(k).alias("side"), F.col(c).alias("block")) for k, c in enumerate("ab")
    ]
    of = F.when(F.col("alone"), F.array(sides[0])).otherwise(F.array(*sides))
    placed = (
        units.select("unit", "alone", F.inline(of))
        .join(members, "block")
        .join(body, "key")
        .select("unit", "alone", "side", "key", "pivot", "linked", "n", "tokens", "df")
    )
    rest = placed.groupBy("unit").applyInArrow(_compare_blocks, EDGES)
    return near.union(rest)


def _units(met: DataFrame, members: DataFrame) -> DataFrame:
    """(unit, a, b, alone): pairs of blocks that meet in a posting list and may yield a link."""
    seen = met.select("key", "token").join(members, "key")
    entry = F.struct("block", "pivot", "linked")
    groups = (
        seen.groupBy("token")
        .agg(F.sort_array(F.collect_set(entry)).alias("blocks"))
        .select("blocks")
        .distinct()
    )
    firsts = groups.select("blocks", F.posexplode("blocks").alias("at", "x"))
    pairs = firsts.select(
        "x",
        F.explode(
            F.filter(
                F.slice("blocks", F.col("at") + 1, F.size("blocks")),
                # Classes that link to one pivot need no comparison among themselves.
                lambda y: ~(
                    F.col("x.linked") & y["linked"] & (F.col("x.pivot") == y["pivot"])
                ),
            )
        ).alias("y"),
    )
    return (
        pairs.select(F.col("x.block").alias("a"), F.col("y.block").alias("b"))
        .distinct()
        .select(
            F.xxhash64("a", "b").alias("unit"), "a", "b", (F.col("a") == F.col("b")).alias("alone")
        )
    )


def components(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, mark, n_shingles, component_id, first), one row per document.

    ``first`` is (doc_id, mark) of the row of its component that comes first: by doc_id, nulls
    last, then by the hash of the text.
    """
    keys = scratch.keep(text_keys(docs), "keys")
    shingles = keys.agg(F.sum("n_shingles").alias("n")).first()["n"] or 0
    sets = scratch.keep(shared_sets(docs, shingles), "sets")
    roots = connected(scratch.keep(links(sets, scratch), "links"), scratch)
    ranked = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark")
    classes = keys.filter("key IS NOT NULL").groupBy("key").agg(F.min(ranked).alias("least"))
    named = classes.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn(
        "root", F.coalesce("root", "key")
    )
    least = named.groupBy("root").agg(F.min("least").alias("first"))
    of_class = scratch.keep(named.join(least, "root").select("key", "first"), "classes")
    own = F.struct(F.col("doc_id"), F.col("mark"))
    first = F.when(F.col("key").isNull(), own).otherwise(
        F.struct(F.col("first.doc_id"), F.col("first.mark"))
    )
    return keys.join(of_class, "key", "left").select(
        "doc_id",
        "mark",
        "n_shingles",
        first["doc_id"].alias("component_id"),
        first.alias("first"),
    )


def join_near(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per document."""
    return components(docs, scratch).select("doc_id", "n_shingles", "component_id")


def keep_one_of_each(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs`` with the first row of every component: see :func:`components`.

    Of rows that are equal in doc_id and text, one stays.
    """
    found = components(docs, scratch)
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (
        F.col("mark") == F.col("first.mark")
    )
    gone = found.filter(~stays).select("doc_id", F.col("mark").alias("gone_mark")).distinct()
    rows = packed(docs).select(
        "row",
        F.col("row.doc_id").cast("long").alias("id"),
        F.xxhash64(F.col("row.text").cast("string")).alias("mark"),
    )
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("mark") == F.col("gone_mark"))
    return unpacked(rows.join(gone, same, "left_anti").dropDuplicates(["id", "mark"]))
