"""Near duplicates by MinHash: one-permutation hashing, optimal densification, banded buckets, star-shaped candidates.

One permutation (the hash of a shingle) makes the whole sketch: its leading bits choose a bin, each bin keeps its
smallest hash, and an empty bin takes the value of the first filled bin in a random sequence of its own (optimal
densification), so that two sketches agree in a bin with a probability of their Jaccard similarity. Bands of ``ROWS``
bins make ``BANDS`` buckets; two sets with a similarity of 0.85 share none of them in 5 of 10^11 cases.

Equal sets are one node. A bucket gives no pairs but a star: its members are compared with one hub, the member with
the most company in all its buckets, and links are confirmed on full sets. Buckets whose members are all
connected drop out, and the others choose another hub. Once stars connect little, what is left in a bucket is
settled exactly, without pairs as rows: in blocks of bounded size, members that are not in the hub's component meet
all of another component. Members whose sketches agree well enough meet again in the same block with their full sets,
and only links that connect components leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderrisk.session import cut_lineage

from .decontaminate import _filter
from .jaccard import components, shingle_sets
from .spread import with_group
from .words import lists, mixed, slices

SHINGLE = 5
PERCENT = 85
BANDS, ROWS = 32, 4
#: Bins of a sketch (a power of two); the first BANDS * ROWS make the bands, one byte of each bin the signature.
BINS = 512
#: Deviations below its mean at which the agreement of two similar sets' signatures may lie: 3 of 10^7 pairs lie lower.
SLACK = 5.0
#: Members of a bucket or of a hub that a block holds.
BLOCK_ROWS = 256
#: Stars go on while they connect at least one in so many of the members that they look at.
STAR_YIELD = 5
#: Random places that an empty bin asks before it asks all in order.
_ASKED = 16 * BINS
#: Rows whose sketches are made together, and bytes of members that a block of a hub holds.
SKETCH_ROWS = 2048
BLOCK_BYTES = 1 << 23


def sketches(found: np.ndarray, ends: np.ndarray, bins: int) -> np.ndarray:
    """One row of ``bins`` values for each set of distinct hashes in ascending order; zeros for an empty set."""
    bits = bins.bit_length() - 1
    owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    place = (found >> np.uint64(64 - bits)).astype(np.int64)
    first = np.ones(len(found), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (place[1:] != place[:-1])
    out, filled = np.zeros((len(ends) - 1, bins), np.uint64), np.zeros((len(ends) - 1, bins), bool)
    out[owner[first], place[first]] = found[first]
    filled[owner[first], place[first]] = True
    row, empty = np.nonzero(~filled & filled.any(axis=1)[:, None])
    turn = 0
    while len(row):
        # Many bins ask one place, few ask several at once; the first filled one counts either way.
        turns = np.arange(turn, turn + (1 if len(row) > 1 << 14 else 64))
        asked = (mixed((empty[:, None] + turns * bins + 1).astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)
        if turn >= _ASKED:
            asked = (empty[:, None] + turns) % bins
        hits = filled[row[:, None], asked]
        hit = hits.any(axis=1)
        source = asked[hit, hits[hit].argmax(axis=1)]
        out[row[hit], empty[hit]] = out[row[hit], source]
        row, empty = row[~hit], empty[~hit]
        turn += len(turns)
    return out


def bands_of(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash for each band of each sketch; equal hashes mean the same band and, as good as surely, equal values."""
    held = sketch[:, : bands * rows].reshape(len(sketch), bands, rows)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) << np.uint64(32), held.shape[:2])
    for i in range(rows):
        out = mixed(out ^ held[:, :, i]) + np.uint64(i)
    return out


def least_agreement(percent: int, bins: int, slack: float = SLACK) -> int:
    """Bins in which the signatures of sets of that similarity agree at least."""
    share = percent / 100
    return int(bins * share - slack * np.sqrt(bins * share * (1 - share)))


def _marks(found: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Two hashes of each whole set."""
    sums = (np.diff(np.concatenate((np.zeros(1, np.uint64), np.cumsum(x)))[ends]) for x in (found, mixed(found)))
    return [mixed(x).view(np.int64) for x in sums]


def sketched(docs: DataFrame, shingle: int, key: str, text: str) -> DataFrame:
    """(row, doc, n, mark, mark2, bands, signature) of every row; n and the marks tell sets apart."""

    def make(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p.slice(at, SKETCH_ROWS) for p in slices(parts, 2) for at in range(0, p.num_rows, SKETCH_ROWS)):
            found, ends = shingle_sets(part.column(2), shingle)
            n = np.diff(ends)
            sketch = sketches(found, ends, BINS)
            has = n > 0
            bands = bands_of(sketch[has], BANDS, ROWS)
            low = (sketch & np.uint64(255)).astype(np.uint8).tobytes()
            signature = pa.array([low[BINS * i : BINS * (i + 1)] for i in range(len(n))], pa.binary())
            columns = [part.column(0), part.column(1), pa.array(n), *map(pa.array, _marks(found, ends))]
            columns += [lists(bands.ravel().view(np.int64), has * BANDS, pa.int64()), signature]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc", "n", "mark", "mark2", "bands", "signature"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    return cut_lineage(rows.mapInArrow(make, "row long, doc long, n long, mark long, mark2 long, bands array<long>, signature binary"))


def _passing(rows: DataFrame, wanted: DataFrame, hashed: str) -> DataFrame:
    """``rows`` whose value of the SQL expression ``hashed`` may be among those of ``wanted``: a bit filter of bounded size."""
    bits, table = _filter(wanted.select(F.expr(hashed).alias("fingerprint")).distinct())
    shared = rows.sparkSession.sparkContext.broadcast(table)
    names = rows.columns

    def pass_some(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            place = part.column(len(names)).to_numpy().view(np.uint64) >> np.uint64(64 - bits)
            marked = shared.value[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)
            yield pa.RecordBatch.from_arrays(part.columns[:-1], names).filter(pa.array(marked.astype(bool)))

    return rows.select("*", F.expr(hashed).alias("_print")).mapInArrow(pass_some, rows.schema)


def full_sets(docs: DataFrame, wanted: DataFrame, shingle: int, text: str) -> DataFrame:
    """(key, n, tokens) of the sets that ``wanted`` (key, n, mark, mark2) names, from a second look at the texts.

    Only candidates have company, so this moves much less than keeping the sets of all texts would write.
    """
    bits, table = _filter(wanted.select(F.col("mark").alias("fingerprint")).distinct())
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def find(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple[int, int]] = set()
        for part in slices(parts, 0):
            found, ends = shingle_sets(part.column(0), shingle)
            marks = _marks(found, ends)
            place = marks[0].view(np.uint64) >> np.uint64(64 - bits)
            marked = (shared.value[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool) & (np.diff(ends) > 0)
            rows = []
            for i in np.flatnonzero(marked).tolist():
                name = (int(marks[0][i]), int(marks[1][i]))
                if name not in sent:
                    sent.add(name)
                    rows.append((int(ends[i + 1] - ends[i]), *name, found[ends[i] : ends[i + 1]].tobytes()))
            if rows:
                columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), [*[pa.int64()] * 3, pa.binary()], strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["n", "mark", "mark2", "tokens"])

    made = docs.select(text).mapInArrow(find, "n long, mark long, mark2 long, tokens binary")
    names = ["n", "mark", "mark2"]
    return made.groupBy(*names).agg(F.first("tokens").alias("tokens")).join(wanted, names).select("key", "n", "tokens")


def _blobs(column: pa.ChunkedArray, kind) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) for x in column]


def _beside_hubs(pairs: DataFrame, held: DataFrame, size: str, alike) -> DataFrame:
    """Those of ``pairs`` (key, hub, n) for which ``alike(members' data, their n, the hub's data, its n)`` holds.

    ``held`` has (key, data). A hub's members are dealt over blocks of bounded rows and bytes, and the hub goes to each.
    """
    counted = pairs.groupBy("hub").agg(F.expr(f"cast(ceil(greatest(count(*) / {BLOCK_ROWS}, sum({size}) / {BLOCK_BYTES})) as int)").alias("salts"))
    members = pairs.join(counted, "hub").select("hub", "key", F.expr("cast(pmod(xxhash64(key), salts) as int)").alias("salt"), F.lit(False).alias("is_hub"))
    salts = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    hubs = counted.select("hub", F.col("hub").alias("key"), salts, F.lit(True).alias("is_hub"))
    rows = members.unionByName(hubs).join(held.select("key", "n", "data"), "key")

    def compare(table: pa.Table) -> pa.Table:
        keys, n, is_hub = table["key"].to_numpy(), table["n"].to_numpy(), table["is_hub"].to_numpy(zero_copy_only=False)
        data = _blobs(table["data"], np.uint8)
        at, others = int(np.flatnonzero(is_hub)[0]), np.flatnonzero(~is_hub)
        kept = others[alike([data[i] for i in others], n[others], data[at], int(n[at]))]
        return pa.table([pa.array(x, pa.int64()) for x in (keys[kept], np.full(len(kept), keys[at]), n[kept])], names=["key", "hub", "n"])

    return rows.groupBy("hub", "salt").applyInArrow(compare, "key long, hub long, n long")


def _similar(some: np.ndarray, whole: np.ndarray, percent: int) -> bool:
    """Whether two full sets, ascending, are similar."""
    place = np.minimum(np.searchsorted(whole, some), len(whole) - 1)
    both = int((whole[place] == some).sum())
    return 100 * both >= percent * (len(some) + len(whole) - both)


def confirmed(pairs: DataFrame, sets: DataFrame, prints: DataFrame, percent: int) -> DataFrame:
    """The (key, hub) of ``pairs`` (key, hub, n) whose full sets are similar; signatures spare most others the look at sets."""
    least = least_agreement(percent, BINS)

    def agree(members: list[np.ndarray], n: np.ndarray, hub: np.ndarray, hub_n: int) -> np.ndarray:
        return np.array([(x == hub).sum() >= least for x in members], bool)

    def similar(members: list[np.ndarray], n: np.ndarray, hub: np.ndarray, hub_n: int) -> np.ndarray:
        return np.array([_similar(x.view("<u8"), hub.view("<u8"), percent) for x in members], bool)

    near = cut_lineage(_beside_hubs(pairs, prints.withColumnRenamed("signature", "data"), str(BINS), agree))
    asked = near.select("key").unionByName(near.select(F.col("hub").alias("key"))).distinct()
    held = _passing(sets.withColumnRenamed("tokens", "data"), asked, "xxhash64(key)")
    return _beside_hubs(near, held, "8 * n", similar).select("key", "hub")


def _left_over(rows: DataFrame, prints: DataFrame, percent: int) -> DataFrame:
    """(bucket, visit, host, key, component, others): members of a block whose sketches agree well enough with one of another component.

    ``rows``: (bucket, band, key, n, component, hub_component). Members outside the hub's component are dealt over
    slices of a bucket and meet all others, slice by slice. ``others`` packs the keys that a visitor agrees with, each pair
    in the first bucket that it shares; it is null for those that are only hosts. So a block gives a row a member, not a pair.
    """
    inside = F.col("component") == F.col("hub_component")
    marked = rows.withColumn("inside", inside.cast("long")).drop("hub_component")
    sides = {"in": F.col("inside"), "out": 1 - F.col("inside")}
    sums = {f"{what}_{side}": (F.sum, is_there * each) for side, is_there in sides.items() for what, each in (("rows", F.lit(1)), ("bytes", 8 * F.col("n")))}
    marked = cut_lineage(with_group(cut_lineage(marked), ["bucket"], sums, ["key"]))
    least = least_agreement(percent, BINS)

    def slices_of(side: str):
        return F.greatest(F.lit(1), F.ceil(F.col(f"rows_{side}") / BLOCK_ROWS), F.ceil(F.col(f"bytes_{side}") / BLOCK_BYTES)).cast("int")

    out_slice = F.pmod(F.xxhash64("key", F.lit(1)), slices_of("out")).cast("int")
    in_slice = F.pmod(F.xxhash64("key", F.lit(2)), slices_of("in")).cast("int")
    # Visitors are the members outside; hosts are those inside in their slices, and after them those outside in theirs.
    host = F.when(F.col("inside") == 1, in_slice).otherwise(slices_of("in") + out_slice)
    common = ["bucket", "band", "key", "n", "component", "inside"]
    hosts = marked.select(*common, F.explode(F.sequence(F.lit(0), slices_of("out") - 1)).alias("visit"), host.alias("host"), F.lit(False).alias("visits"))
    every = F.explode(F.sequence(F.lit(0), slices_of("in") + slices_of("out") - 1)).alias("host")
    guests = marked.where("inside = 0").select(*common, out_slice.alias("visit"), every, F.lit(True).alias("visits"))
    met = hosts.unionByName(guests).join(prints.select("key", "signature"), "key")

    def meet(table: pa.Table) -> pa.Table:
        visits = table["visits"].to_numpy(zero_copy_only=False)
        keys, n, component, inside = (table[c].to_numpy() for c in ("key", "n", "component", "inside"))
        signature = np.array(_blobs(table["signature"], np.uint8))
        bands, band = signature.view("<u4")[:, :BANDS], int(table["band"][0].as_py())
        mine = np.flatnonzero(~visits)
        asked: list[int] = []
        found: list[np.ndarray] = []
        for i in np.flatnonzero(visits).tolist():
            small, large = np.minimum(n[mine], n[i]), np.maximum(n[mine], n[i])
            # Two visitors meet twice, and count once.
            once = (inside[mine] == 1) | (keys[mine] > keys[i])
            some = mine[once & (100 * small >= percent * large) & (component[mine] != component[i])]
            some = some[(signature[some] == signature[i]).sum(axis=1) >= least]
            some = some[~(bands[some, :band] == bands[i, :band]).any(axis=1)]
            if len(some):
                asked.append(i)
                found.append(some)
        hosts = np.unique(np.concatenate([np.zeros(0, np.int64), *found]))
        hosts = hosts[~np.isin(keys[hosts], keys[asked])]
        others = [keys[some].astype("<i8").tobytes() for some in found] + [None] * len(hosts)
        rows_out = table.select(names).take(pa.array(np.concatenate((np.array(asked, np.int64), hosts))))
        return rows_out.append_column("others", pa.array(others, pa.binary()))

    names = ["bucket", "visit", "host", "key", "component"]
    return met.groupBy("bucket", "visit", "host").applyInArrow(meet, "bucket long, visit int, host int, key long, component long, others binary")


def _block_links(blocks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(key, hub): of the pairs in ``blocks`` (see :func:`_left_over`) whose full sets are similar, those that connect components of a block."""
    held = _passing(sets, blocks.select("key").distinct(), "xxhash64(key)")

    def settle(table: pa.Table) -> pa.Table:
        keys, component = table["key"].to_pylist(), table["component"].to_pylist()
        tokens, place = _blobs(table["tokens"], "<u8"), {k: i for i, k in enumerate(keys)}
        above = {c: c for c in component}
        links = []

        def top(c: int) -> int:
            while above[c] != c:
                above[c] = c = above[above[c]]
            return c

        for i, others in enumerate(table["others"]):
            for j in [place[k] for k in np.frombuffer(others.as_buffer(), "<i8").tolist()] if others.is_valid else []:
                a, b = top(component[i]), top(component[j])
                if a != b and _similar(tokens[j], tokens[i], percent):
                    above[a] = b
                    links.append((keys[j], keys[i]))
        return pa.table([pa.array([pair[c] for pair in links], pa.int64()) for c in (0, 1)], names=["key", "hub"])

    return blocks.join(held.select("key", "tokens"), "key").groupBy("bucket", "visit", "host").applyInArrow(settle, "key long, hub long")


def duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, n_shingles, component_id (the smallest key reachable by links) and kept (whether that is its own).

    Rows link when their sets of distinct word shingles have a Jaccard similarity of ``percent`` / 100 or more, at least
    0.8 by the parameters of the sketch. Words lie between white space in whole texts of any length, A-Z count as a-z,
    and a text of fewer words is one shingle. Null and empty texts have empty sets and link with nothing. Every row
    is a node of its own, so a repeated key connects nothing; component_id is null, and kept true, only where
    no row of the component has a key, and a row without a key beside one with a key is not kept. Rows that repeat
    key and text have the same result. An empty table gives no rows; further columns are left out.
    """
    kind = docs.schema[key].dataType.simpleString()
    state = sketched(docs, shingle, key, text)
    # Equal sets are one node, that of the smallest row, and bear its sketch.
    equal = ["n", "mark", "mark2"]
    some = state.where("n > 0").select("row", "doc", *equal)
    twins = cut_lineage(with_group(some, equal, {"key": (F.min, F.col("row")), "least": (F.min, F.col("doc"))}, ["row"]))
    nodes = twins.where("row = key").select("key", "least")
    sketch = state.select("row", "n", "bands").join(nodes.select(F.col("key").alias("row")), "row")
    places = cut_lineage(sketch.select(F.col("row").alias("key"), "n", F.posexplode("bands").alias("band", "bucket")))
    # Only buckets with company go on; how much of it a set has is its rank as a hub.
    shared = cut_lineage(places.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1"))
    places = cut_lineage(_passing(places, shared, "bucket").join(shared, "bucket"))
    company = cut_lineage(places.groupBy("key").agg(F.sum("members").alias("company")))
    places = cut_lineage(places.drop("members").join(company, "key"))
    wanted = _passing(twins.where("row = key").select("key", "n", "mark", "mark2"), company, "xxhash64(key)")
    wanted = cut_lineage(wanted.join(company.select("key"), "key", "left_semi"))
    sets = cut_lineage(full_sets(docs, wanted, shingle, text))
    prints = _passing(state.select(F.col("row").alias("key"), "n", "signature"), wanted, "xxhash64(key)")
    prints = cut_lineage(prints.join(wanted.select("key"), "key", "left_semi"))
    links: list[DataFrame] = []
    tested: list[DataFrame] = []
    labels: DataFrame | None = None

    def united(tables: list[DataFrame]) -> DataFrame:
        out = tables[0]
        for more in tables[1:]:
            out = out.unionByName(more)
        return out

    def labelled() -> DataFrame:
        if labels is None:
            return places.withColumn("component", F.col("key"))
        return places.join(labels, "key", "left").withColumn("component", F.coalesce("component", "key"))

    def untested(pairs: DataFrame) -> DataFrame:
        if tested:
            done = united(tested).select("key", "hub")
            both = done.unionByName(done.select(F.col("hub").alias("key"), F.col("key").alias("hub")))
            pairs = pairs.join(both, ["key", "hub"], "left_anti")
        return cut_lineage(pairs)

    def with_hubs(turn: int) -> DataFrame:
        """Members of buckets with more than one component, beside their hub."""
        rank = -F.col("company") if not turn else F.xxhash64("key", F.lit(turn))
        me = F.struct(rank.alias("rank"), "key", "n", "component")
        component = F.col("component")
        found = {"hub": (F.min, me), "low": (F.min, component), "top": (F.max, component)}
        return with_group(cut_lineage(labelled()), ["bucket"], found, ["key"]).where("low != top").drop("low", "top", "company")

    turn = 0
    while True:
        rows = cut_lineage(with_hubs(turn))
        hub = F.col("hub")
        fits = 100 * F.least("n", hub["n"]) >= percent * F.greatest("n", hub["n"])
        stars = rows.where(fits & (F.col("component") != hub["component"])).select("key", hub["key"].alias("hub"), "n").distinct()
        stars = untested(stars)
        n_stars = stars.count()
        if not n_stars:
            break
        tested.append(stars)
        passed = cut_lineage(confirmed(stars, sets, prints, percent))
        n_passed = passed.count()
        if n_passed:
            links.append(passed)
            labels = components(united(links))
        turn += 1
        if STAR_YIELD * n_passed < n_stars:
            break
    rows = with_hubs(0).select("bucket", "band", "key", "n", "component", F.col("hub.component").alias("hub_component"))
    blocks = cut_lineage(_left_over(cut_lineage(rows), prints, percent))
    if blocks.head(1):
        passed = cut_lineage(_block_links(blocks, sets, percent))
        if passed.head(1):
            labels = components(united([*links, passed]))
    # Names: the smallest document of each component, spread back over nodes and rows.
    if labels is None:
        named = nodes.select("key", F.col("least").alias("name"))
    else:
        linked = cut_lineage(nodes.join(labels, "key"))
        linked = with_group(linked, ["component"], {"name": (F.min, F.col("least"))}, ["key"])
        named = nodes.join(linked.select("key", "name", F.lit(True).alias("linked")), "key", "left")
        named = named.select("key", F.when(F.col("linked"), F.col("name")).otherwise(F.col("least")).alias("name"))
    out = with_group(cut_lineage(twins.join(named.withColumnRenamed("key", "row"), "row", "left")), equal, {"found": (F.min, F.col("name"))}, ["row"])
    rows = out.select("doc", "n", "found").unionByName(state.where("n = 0").select("doc", "n", F.col("doc").alias("found")))
    return rows.select(
        F.col("doc").cast(kind).alias(key), F.col("n").alias("n_shingles"), F.col("found").cast(kind).alias("component_id"), F.col("doc").eqNullSafe(F.col("found")).alias("kept")
    )
