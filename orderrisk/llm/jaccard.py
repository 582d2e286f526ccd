"""N-gram Jaccard join with prefix filters under several global token orders.

Two sets with a Jaccard similarity of at least t share a token among the first |x| - ceil(t |x|) + 1 of
each under any global order. All orders here begin with the rarest tokens and differ in how they order
tokens of like frequency. A token of one set only can be shared with none, so a set with enough of them
has no candidates, and only the other tokens come back from the count. Candidates share a prefix token
under the first order and pass size and place filters; the other orders are tested beside the whole sets.

Groups of near copies are not expanded into pairs: within a block (the sets that share a prefix token)
members are compared with one hub, and what is connected already is not compared again. When hubs connect
nothing more, all remaining pairs between different components that pass every filter are verified. One of the filters is
a bitmap of parities: sets differ in at least as many tokens as their bitmaps in bits, so that most members of a block that
share a token and little else never become rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderrisk.session import cut_lineage, drop_table

from .decontaminate import _filter
from .words import MOST_PARTITIONS, SPACED, grams, mixed, run_hashes, slices, words

SHINGLE = 5
PERCENT = 75
BUCKET_BYTES = 8 << 20
SALT_ROWS = 256
HUB_YIELD = 5
#: Words of 64 bits in a set's bitmap (a power of two), and sets whose bitmaps are made together.
BITMAP_WORDS = 8
BITMAP_ROWS = 1024
_ORDERS = tuple(np.uint64(x) for x in (0, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
_DOC = np.dtype([("key", "<i8"), ("n", "<i8"), ("twin", "<i8"), ("place", "<i4"), ("doc", "<i8"), ("known", "?")])


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text as hashes, ascending, and where each set ends."""
    hashes, ends = words(column, SPACED)
    found, fits = grams(hashes, ends, size)
    owner = np.repeat(np.arange(len(column)), np.diff(ends))[fits]
    short = np.flatnonzero((np.diff(ends) > 0) & (np.diff(ends) < size))
    found = np.concatenate((found[fits], run_hashes(hashes, ends[short], ends[short + 1])))
    owner = np.concatenate((owner, short))
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    return found[new], np.concatenate(([0], np.cumsum(np.bincount(owner[new], minlength=len(column))))).astype(np.int64)


def _prefix(n: np.ndarray, percent: int) -> np.ndarray:
    return n + (-percent * n) // 100 + 1


def _ranked(tokens: np.ndarray, rarity: np.ndarray, order: int) -> np.ndarray:
    return np.lexsort((mixed(tokens ^ _ORDERS[order]), rarity))


def _token_blobs(docs: DataFrame, shingle: int, buckets: int) -> DataFrame:
    def send(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part_no, piece = TaskContext.get().partitionId(), 0
        for part in slices(parts, 1):
            found, ends = shingle_sets(part.column(1), shingle)
            table = np.zeros(part.num_rows, _DOC)
            table["key"], table["n"], table["place"] = part.column(0).to_numpy(), np.diff(ends), np.arange(part.num_rows)
            table["doc"], table["known"] = part.column(2).fill_null(0).to_numpy(), part.column(2).is_valid().to_numpy(zero_copy_only=False)
            # Equal sets of a batch go as one, that of the smallest key.
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(found)))
            turned = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(found))))
            marks = [np.diff(x[ends]) for x in (sums, turned)]
            order = np.lexsort((table["key"], *marks, table["n"]))
            new = np.ones(len(order), bool)
            new[1:] = np.logical_or.reduce([x[order][1:] != x[order][:-1] for x in (*marks, table["n"])]) | (table["n"][order][1:] == 0)
            table["twin"][order] = table["key"][order][new][np.cumsum(new) - 1]
            alone = np.zeros(len(order), bool)
            alone[order[new]] = True
            owner = np.repeat(np.arange(len(table)), np.diff(ends))
            sent = alone[owner]
            found, owner = found[sent], owner[sent].astype(np.uint32)
            bucket = ((found >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[by], np.arange(buckets + 1))
            rows = []
            for b in range(buckets):
                some = by[cuts[b] : cuts[b + 1]]
                if len(some) or not b:
                    # 48 bits and the bucket tell tokens apart; each document's number of tokens stands for its place.
                    low, mid = found[some].astype("<u4"), (found[some] >> np.uint64(32)).astype("<u2")
                    counts = np.bincount(owner[some], minlength=len(table)).astype("<u2" if np.bincount(owner[some], minlength=1).max() < 65_536 else "<u4")
                    held = [low.tobytes(), mid.tobytes(), counts.tobytes(), table.tobytes() if not b else b""]
                    rows.append((b, part_no << 24 | piece, len(table), *held))
            piece += 1
            kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["bucket", "batch", "docs", "low", "mid", "counts", "table"])

    schema = "bucket int, batch long, docs long, low binary, mid binary, counts binary, table binary"
    return docs.mapInArrow(send, schema)


def _bytes(column: pa.ChunkedArray) -> list[bytes]:
    return [x.as_buffer().to_pybytes() for x in column]


def _count(table: pa.Table) -> pa.Table:
    """Back to each batch: tokens that more than one set has, their documents and how frequent they are."""
    low, mid, counts = (_bytes(table[c]) for c in ("low", "mid", "counts"))
    docs, bucket = table["docs"].to_pylist(), table["bucket"][0].as_py()
    tokens = [np.frombuffer(a, "<u4").astype("<u8") | np.frombuffer(b, "<u2").astype("<u8") << np.uint64(32) for a, b in zip(low, mid, strict=True)]
    ends = np.cumsum([0, *map(len, tokens)])
    flat = np.concatenate(tokens) | np.uint64(bucket % 65_536) << np.uint64(48)
    order = np.argsort(flat)
    new = np.ones(len(flat), bool)
    new[1:] = flat[order][1:] != flat[order][:-1]
    starts = np.flatnonzero(new)
    runs = np.diff(np.append(starts, len(flat)))
    times = np.empty(len(flat), np.int64)
    times[order] = np.repeat(runs, runs)
    out = []
    for i, n in enumerate(docs):
        mine = times[ends[i] : ends[i + 1]]
        kept = mine > 1
        each = np.frombuffer(counts[i], "<u2" if n and len(counts[i]) == 2 * n else "<u4")
        owner = np.repeat(np.arange(n, dtype="<u4"), each)
        rarity = np.minimum(4 * np.log2(np.maximum(mine, 1)), 255).astype(np.uint8)
        out.append((flat[ends[i] : ends[i + 1]][kept].tobytes(), owner[kept].tobytes(), rarity[kept].tobytes()))
    columns = [pa.array(x, pa.binary()) for x in zip(*out, strict=True)]
    return pa.table({"batch": table["batch"], "tokens": columns[0], "owner": columns[1], "rarity": columns[2], "table": table["table"]})


def _sets(percent: int):
    def gather(table: pa.Table) -> pa.Table:
        docs = np.frombuffer(b"".join(_bytes(table["table"])), _DOC)
        tokens, owner, rarity = (np.frombuffer(b"".join(_bytes(table[c])), t) for c, t in (("tokens", "<u8"), ("owner", "<u4"), ("rarity", np.uint8)))
        order = np.lexsort((mixed(tokens ^ _ORDERS[0]), rarity, owner))
        tokens, owner, rarity = tokens[order], owner[order], rarity[order]
        ends = np.searchsorted(owner, np.arange(len(docs) + 1))
        lone = docs["n"] - np.diff(ends)
        able = (np.diff(ends) > 0) & (lone < _prefix(docs["n"], percent))
        held = [tokens[a:b].tobytes() if go else None for a, b, go in zip(ends, ends[1:], able, strict=False)]
        marks = [rarity[a:b].tobytes() if go else None for a, b, go in zip(ends, ends[1:], able, strict=False)]
        columns = [pa.array(np.ascontiguousarray(docs[c])) for c in ("key", "n", "twin")]
        doc = pa.array(np.ascontiguousarray(docs["doc"]), mask=~docs["known"])
        return pa.table([*columns, doc, pa.array(lone), pa.array(held, pa.binary()), pa.array(marks, pa.binary())], names=["key", "n", "twin", "doc", "lone", "tokens", "rarity"])

    return gather


def _prefixes(sets: DataFrame, percent: int, marked: tuple[int, np.ndarray] | None = None) -> DataFrame:
    """(token, key, n, lone, at): each set's shared prefix tokens under the first order and their places; its component too if ``sets`` has one.

    Tokens of one set only come first in every order, so the others' places begin at ``lone``. They are mixed, so that a bit filter
    of their leading bits, ``marked``, may leave out tokens that it lacks.
    """
    keep = ["key", "n", "lone", *(c for c in sets.columns if c == "component")]
    names = ["token", *keep, "at"]
    bits, shared = (marked[0], sets.sparkSession.sparkContext.broadcast(marked[1])) if marked else (0, None)

    def take(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows: list[list[np.ndarray]] = [[np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
            n, lone = part.column(1).to_numpy(), part.column(2).to_numpy()
            length = _prefix(n, percent) - lone
            for i, t in enumerate(part.column(len(keep))):
                t = np.frombuffer(t.as_buffer(), "<u8")[: length[i]]
                for column, more in zip(rows, (t, np.full(len(t), i), lone[i] + np.arange(len(t))), strict=True):
                    column.append(more)
            token, who, at = (np.concatenate(x) for x in rows)
            token = mixed(token)
            if shared is not None:
                place = token >> np.uint64(64 - bits)
                held = (shared.value[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
                token, who, at = token[held], who[held], at[held]
            columns = [part.column(i).take(pa.array(who)) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), *columns, pa.array(at)], names)

    return sets.select(*keep, "tokens").mapInArrow(take, ", ".join(f"{c} long" for c in names))


def _unsettled(sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """The prefix rows of blocks that hold several components (and of few others), with their components.

    Labels meet prefixes and not their tokens, so that a row a set moves by key, and tokens move with their components
    alone. A bit filter then tells which tokens' rows are wanted.
    """
    head = F.expr(f"substring(tokens, 1, cast(8 * (n + floor(-{percent} * n / 100) + 1 - lone) as int))")
    heads = cut_lineage(_labelled(sets.select("key", "n", "lone", head.alias("tokens")), labels))
    spread = _prefixes(heads, percent).groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("top"))
    several = cut_lineage(spread.where("top != low").select(F.col("token").alias("fingerprint")))
    rows = _prefixes(heads, percent, _filter(several))
    drop_table(several)
    return rows


def _able(shared: Column, n: Column, other: Column, percent: int) -> Column:
    """Whether sets of these sizes can be similar if they share at most so many tokens."""
    return shared * (100 + percent) >= (n + other) * percent


def _bitmaps(sets: DataFrame) -> DataFrame:
    """(key, b0, b1, ...): of each bit whether an odd number of a set's shared tokens fall on it.

    A token in one of two sets only turns one bit, so they differ in at least as many tokens as their bitmaps in bits.
    """
    bits = 64 * BITMAP_WORDS
    names = ["key", *(f"b{i}" for i in range(BITMAP_WORDS))]

    def make(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p.slice(at, BITMAP_ROWS) for p in parts for at in range(0, p.num_rows, BITMAP_ROWS)):
            tokens = [np.frombuffer(x.as_buffer(), "<u8") for x in part.column(1)]
            owner = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
            bit = (mixed(np.concatenate(tokens)) >> np.uint64(65 - bits.bit_length())).astype(np.int64)
            odd = np.bincount(owner * bits + bit, minlength=len(tokens) * bits).reshape(-1, bits) & 1
            words_of = np.packbits(odd.astype(np.uint8), axis=1).view("<i8")
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(np.ascontiguousarray(words_of[:, i])) for i in range(BITMAP_WORDS))], names)

    return sets.select("key", "tokens").mapInArrow(make, ", ".join(f"{c} long" for c in names))


def _pairs(rows: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """(key, hub) of different components that can be similar, as far as prefixes tell.

    The smaller set of a pair needs only the tokens before its place n - 2 percent n / (100 + percent). All tokens
    shared up to the last one that both prefixes hold are counted, and after it no more follow than the
    shorter rest. Sets whose bitmaps differ too much share a token in vain and are no row of the join.
    """
    marks = [c for c in bitmaps.columns if c != "key"]
    rows = cut_lineage(rows.join(bitmaps, "key"))
    small = rows.where((F.col("n") - F.col("at")) * (100 + percent) >= F.col("n") * (2 * percent))
    large = rows.select("token", *(F.col(c).alias(f"{c}2") for c in ("key", "n", "lone", "at", "component", *marks)))
    ordered = (F.col("n") < F.col("n2")) | ((F.col("n") == F.col("n2")) & (F.col("key") < F.col("key2")))
    most = F.least(F.col("n") - F.col("lone"), F.col("n2") - F.col("lone2"))
    rest = F.least(F.col("n") - F.col("at"), F.col("n2") - F.col("at2"))
    differ = reduce(add, (F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}2"))) for c in marks))
    held = F.col("n") - F.col("lone") + F.col("n2") - F.col("lone2")
    alike = _able(held - differ, 2 * F.col("n"), 2 * F.col("n2"), percent)
    fits = _able(most, F.col("n"), F.col("n2"), percent) & (F.col("component") != F.col("component2")) & ordered & alike
    met = small.join(large, "token").where(fits)
    met = met.groupBy("key", "key2", "n", "n2").agg(F.count("*").alias("c"), F.min(rest).alias("rest"))
    return met.where(_able(F.col("c") + F.col("rest") - 1, F.col("n"), F.col("n2"), percent)).select("key", F.col("key2").alias("hub"))


def _verify(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``edges`` (key, hub) whose sets are similar. Hubs with many members are dealt over several groups."""
    counted = edges.groupBy("hub").agg(F.expr(f"cast(ceil(count(*) / {SALT_ROWS}) as int)").alias("salts"))
    members = edges.join(counted, "hub").select("hub", "key", F.expr("cast(pmod(xxhash64(key), salts) as int)").alias("salt"))
    hubs = counted.select("hub", F.col("hub").alias("key"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    rows = members.unionByName(hubs).join(sets.select("key", "n", "lone", "tokens", "rarity"), "key")

    def compare(table: pa.Table) -> pa.Table:
        hub = table["hub"][0].as_py()
        keys, n, lone = (table[c].to_numpy() for c in ("key", "n", "lone"))
        tokens = [np.frombuffer(x, "<u8") for x in _bytes(table["tokens"])]
        rarity = [np.frombuffer(x, np.uint8) for x in _bytes(table["rarity"])]
        length = _prefix(n, percent) - lone
        found = []
        for h in np.flatnonzero(keys == hub):
            whole = np.sort(tokens[h])
            heads = [np.sort(tokens[h][_ranked(tokens[h], rarity[h], o)[: length[h]]]) for o in range(len(_ORDERS))]

            def shared(some: np.ndarray, of: np.ndarray) -> int:
                at = np.minimum(np.searchsorted(of, some), len(of) - 1)
                return int((of[at] == some).sum())

            for i in np.flatnonzero(keys != hub):
                small, large = sorted((n[i], n[h]))
                if 100 * small < percent * large:
                    continue
                orders = (tokens[i][_ranked(tokens[i], rarity[i], o)[: length[i]]] for o in range(len(_ORDERS)))
                if not all(shared(head, of) for head, of in zip(orders, heads, strict=True)):
                    continue
                both = shared(tokens[i], whole)
                if 100 * both >= percent * (n[i] + n[h] - both):
                    found.append(int(keys[i]))
        return pa.table({"key": pa.array(found, pa.int64()), "hub": pa.array([hub] * len(found), pa.int64())})

    return rows.groupBy("hub", "salt").applyInArrow(compare, "key long, hub long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(key, component): the smallest key that (key, hub) links reach, for every key that has a link.

    Each pass takes the smallest label among neighbours and then the label of that label, so that the
    number of passes grows with the logarithm of a component's width.
    """
    both = links.select("key", "hub").unionByName(links.select(F.col("hub").alias("key"), F.col("key").alias("hub")))
    both = cut_lineage(both.distinct())
    labels = cut_lineage(both.groupBy("key").agg(F.least(F.min("hub"), F.col("key")).alias("component")))
    while True:
        near = both.join(labels.select(F.col("key").alias("hub"), "component"), "hub").groupBy("key").agg(F.min("component").alias("near"))
        lower = labels.join(near, "key").select("key", F.least("component", "near").alias("lower"), F.col("component").alias("was"))
        lower = cut_lineage(lower)
        jumps = lower.select(F.col("key").alias("lower"), F.col("lower").alias("jump"))
        labels = cut_lineage(lower.join(jumps, "lower", "left").select("key", F.least("lower", F.coalesce("jump", "lower")).alias("component"), "was"))
        if not labels.where(F.col("component") != F.col("was")).head(1):
            return labels.select("key", "component")
        labels = labels.select("key", "component")


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return rows.withColumn("component", F.col("key"))
    return rows.join(labels, "key", "left").withColumn("component", F.coalesce("component", "key"))


def _named(state: DataFrame, labels: DataFrame | None, null_is_least: bool) -> DataFrame:
    """(doc, n, name) of each row; name is the smallest doc of its component."""
    rows = state.select("key", "doc", "n")
    if labels is None:
        return rows.withColumn("name", F.col("doc"))
    linked = cut_lineage(labels.join(rows.select("key", "doc"), "key"))
    least = F.min("doc")
    if null_is_least:
        least = F.when(F.count("doc") == F.count("*"), least)
    named = linked.join(linked.groupBy("component").agg(least.alias("name")), "component").select("key", "name", F.lit(True).alias("linked"))
    return rows.join(named, "key", "left").select("doc", "n", F.when(F.col("linked"), F.col("name")).otherwise(F.col("doc")).alias("name"))


def join(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, key: str = "doc_id", text: str = "text", null_is_least: bool = True
) -> DataFrame:
    """Per row: ``key``, n_shingles and component_id, the smallest key reachable by links.

    Rows link when their sets of distinct word shingles have a Jaccard similarity of ``percent`` / 100
    or more. Words lie between white space, A-Z count as a-z, and a text of fewer words is one shingle. Null
    and empty texts have empty sets and link with nothing. Every row is a node of its own, so a repeated or null
    key connects nothing. ``null_is_least``: a null key counts as the smallest; otherwise component_id is null
    only where no row of the component has a key. An empty table gives no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    held = docs.select(F.monotonically_increasing_id().alias("key"), F.col(text).alias("text"), F.col(key).cast("long").alias("doc"))
    total = held.select(F.sum(F.octet_length("text"))).head()[0] or 0
    buckets = max(8, int(total // BUCKET_BYTES) + 1)
    parts = min(buckets, MOST_PARTITIONS)
    shared = _token_blobs(held, shingle, buckets).repartition(parts, "bucket").groupBy("bucket").applyInArrow(
        _count, "batch long, tokens binary, owner binary, rarity binary, table binary"
    )
    state = shared.repartition(parts, "batch").groupBy("batch").applyInArrow(_sets(percent), "key long, n long, twin long, doc long, lone long, tokens binary, rarity binary")
    state = cut_lineage(state)
    sets = state.where("tokens is not null")
    first = cut_lineage(_prefixes(sets, percent))
    links = cut_lineage(state.where("key != twin and n > 0").select("key", F.col("twin").alias("hub")).distinct())
    tested: DataFrame | None = None
    labels = components(links) if links.head(1) else None
    turn, narrowed = 0, False

    def labelled(first: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The table of prefix rows that holds from now on, and its rows with their components."""
        if labels is None or narrowed:
            return first, _labelled(first, labels)
        drop_table(first)
        rows = _unsettled(sets, labels, percent)
        return rows, rows

    while True:
        # Equal sets of a batch have sent one; to begin with each set that has tokens is a component of its own.
        first, rows = labelled(first) if turn else (first, _labelled(first, None))
        # The hub: the member with the fewest tokens of its own, another one in each turn.
        rank = F.struct((F.xxhash64("key", F.lit(turn)) if turn else F.col("lone")).alias("rank"), "key", "n", "lone", "component")
        spread = rows.groupBy("token").agg(F.min(rank).alias("hub"), F.max("component").alias("top"), F.min("component").alias("low"))
        # A block whose members are connected stays so, and is not looked at again.
        mixed_rows = cut_lineage(rows.join(spread.where("top != low").select("token", "hub"), "token"))
        drop_table(first)
        first = mixed_rows.select("token", "key", "n", "lone", "at")
        narrowed = turn > 0
        hub = F.col("hub")
        most = F.least(F.col("n") - F.col("lone"), hub["n"] - hub["lone"])
        able = _able(most, F.col("n"), hub["n"], percent) & (F.col("component") != hub["component"])
        near = mixed_rows.where(able).groupBy("key", hub["key"].alias("hub")).agg(F.count("*").alias("n"))
        if tested is not None:
            near = near.join(tested, ["key", "hub"], "left_anti")
        best = near.groupBy("key").agg(F.max(F.struct("n", "hub")).alias("b")).select("key", F.col("b.hub").alias("hub"))
        best = cut_lineage(best)
        if not best.head(1):
            break
        passed = cut_lineage(_verify(best, sets, percent))
        tested = best if tested is None else cut_lineage(tested.unionByName(best))
        turn += 1
        n_passed = passed.count()
        if n_passed:
            links = cut_lineage(links.unionByName(passed))
            labels = components(links)
        # Where hubs connect few members any more, the rest is settled pair by pair.
        if HUB_YIELD * n_passed < best.count():
            break
    pairs = _pairs(labelled(first)[1], _bitmaps(sets), percent)
    if tested is not None:
        both = tested.unionByName(tested.select(F.col("hub").alias("key"), F.col("key").alias("hub")))
        pairs = pairs.join(both, ["key", "hub"], "left_anti")
    pairs = cut_lineage(pairs)
    passed = cut_lineage(_verify(pairs, sets, percent))
    if passed.head(1):
        labels = components(cut_lineage(links.unionByName(passed)))
    out = _named(state, labels, null_is_least)
    return out.select(F.col("doc").cast(kind).alias(key), F.col("n").alias("n_shingles"), F.col("name").cast(kind).alias("component_id"))
