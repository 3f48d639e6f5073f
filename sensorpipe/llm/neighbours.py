"""Near-duplicate vectors by NN-descent: a neighbour graph is refined through neighbours of neighbours."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sensorpipe.llm.graph import components
from sensorpipe.llm.ship import ship
from sensorpipe.llm.spread import attach
from sensorpipe.session import drop_staged, staged

THRESHOLD = 0.98
#: Neighbours that a vector lists; a vector whose entries are all links is saturated, and compared with all saturated ones.
LISTED = 10
#: The first graph: tables of random hyperplanes, and how many rows ahead a row is compared in each table's order.
#: With 60 planes the order goes on to part rows whatever their number; a code is a whole number of 64 bits.
TABLES, PLANES, AHEAD = 6, 60, 4
#: Neighbours that meet in one local join; the list of a hub is dealt into several, anew in each round.
MEET = 48
#: Rounds before the first audit; audits that may fall short before all vectors are compared; no audit while a round adds this share.
ROUNDS, MORE_ROUNDS, GAIN = 2, 4, 0.01
#: Vectors first asked in an audit, the most at a time, the true links it has to see, and the share of them to reach.
AUDITED, MOST_ASKED, AUDIT_LINKS, RECALL = 512, 4096, 300, 0.97
#: Vectors in a block, of either side, when saturated vectors are compared.
BLOCK = 1024
#: Cells of saturated vectors (their leaders are broadcast), angles computed at a time, and what rounding may do to an angle.
MOST_CELLS, ANGLES, SLACK = 16_384, 1 << 21, 1e-6
#: Stands for a vec_id that is null.
NO_ID = 1 << 62


def _of_length_one(rows: np.ndarray) -> np.ndarray:
    # Squares of very large or small entries leave the range of a double; a power of two changes no digit.
    rows = np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def unit(vectors: pd.Series) -> np.ndarray:
    """Rows of length one, in double precision."""
    return _of_length_one(np.stack([np.asarray(v, np.float64) for v in vectors]))


def _usable(vectors: DataFrame) -> DataFrame:
    """(id, kind, vector) of vectors that can be compared; ``kind`` is label and length."""
    whole = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    fine = F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(whole, lambda x: x != 0), F.lit(False))
    kind = F.concat_ws("/", F.col("label").cast("string"), F.size("embedding").cast("string"))
    return vectors.select("id", F.when(fine, kind).alias("kind"), F.when(fine, whole).alias("vector"))


def _first_graph(classes: DataFrame, seed: int) -> DataFrame:
    """Pairs of vectors that stand close in the order of their sides of random hyperplanes."""

    def codes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, part in batch.groupby(batch["vector"].map(len)):
                x = unit(part["vector"])
                for table in range(TABLES):
                    planes = np.random.default_rng([seed, table, int(size)]).standard_normal((int(size), PLANES))
                    code = ((x @ planes > 0) @ (1 << np.arange(PLANES)[::-1])).astype(np.int64)
                    yield part.assign(table=table, code=code)[["table", "kind", "code", "cid", "vector"]]

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tail = None
        for batch in batches:
            rows = batch if tail is None else pd.concat([tail, batch], ignore_index=True)
            tail = rows.tail(AHEAD)
            for (_, _), part in rows.groupby(["table", "kind"], sort=False):
                x, cid = unit(part["vector"]), part["cid"].to_numpy()
                for step in range(1, min(AHEAD, len(part) - 1) + 1):
                    yield pd.DataFrame({"u": cid[:-step], "v": cid[step:], "cosine": np.einsum("ij,ij->i", x[:-step], x[step:])})

    coded = classes.mapInPandas(codes, "table int, kind string, code long, cid long, vector array<double>")
    order = ["table", "kind", "code", F.xxhash64("cid")]
    return coded.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(pairs, "u long, v long, cosine double")


def _lists(pairs: DataFrame) -> DataFrame:
    """The LISTED nearest of each vector, from unordered pairs that may repeat: (u, v, cosine)."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"), "cosine")).filter("u <> v")
    unique = both.groupBy("u", "v").agg(F.max("cosine").alias("cosine"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("cosine"), "v"))
    return unique.withColumn("rank", rank).filter(F.col("rank") <= LISTED).drop("rank")


def _refine(lists: DataFrame, classes: DataFrame, turn: int) -> DataFrame:
    """One round: whoever is a neighbour of the same vector, in either direction, is compared with each other.

    Pairs are kept that are nearer than the last entry in the list of one of the two.
    """
    last = lists.groupBy("u").agg(F.when(F.count(F.lit(1)) >= LISTED, F.min("cosine")).otherwise(-2.0).alias("last"))
    around = lists.select(F.col("u").alias("centre"), F.col("v").alias("cid")).unionByName(lists.select(F.col("v").alias("centre"), F.col("u").alias("cid"))).distinct()
    around = staged(around)
    size = around.groupBy("centre").agg(F.count(F.lit(1)).alias("size"))
    seats = attach(around, size, ["centre"], F.col("cid"))
    seat = F.pmod(F.xxhash64("cid", F.lit(turn)), F.ceil(F.col("size") / MEET)).cast("int")
    known = classes.join(last.withColumnRenamed("u", "cid"), "cid", "left").select("cid", "vector", F.coalesce("last", F.lit(-2.0)).alias("last"))
    met = attach(seats.select("centre", "cid", seat.alias("seat")), known, ["cid"], F.col("centre"))

    # Meetings are small and very many: sorted rows are compared a batch at a time, not a group at a time.
    order = ["centre", "seat"]
    seated = met.select(*order, "cid", "last", "vector").repartition(*order).sortWithinPartitions(*order)
    return seated.mapInArrow(_compare_meetings, "u long, v long, cosine double")


def _compare_meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs within each run of equal centre and seat that are nearer than the last entry of one of the two."""

    def compare(table: pa.Table) -> pa.RecordBatch:
        starts = _starts(table)
        vectors = table["vector"].combine_chunks()
        flat, ends = vectors.flatten().to_numpy(zero_copy_only=False), np.asarray(vectors.offsets)
        cid, last = table["cid"].to_numpy(), table["last"].to_numpy()
        found = ([], [], [])
        for a, b in zip(starts, [*starts[1:], len(cid)]):
            if b - a < 2:
                continue
            x = _of_length_one(flat[ends[a] - ends[0] : ends[b] - ends[0]].reshape(b - a, -1))
            i, j = np.triu_indices(b - a, 1)
            cosine = (x @ x.T)[i, j]
            better = cosine > np.minimum(last[a:b][i], last[a:b][j])
            for out, column in zip(found, (cid[a:b][i[better]], cid[a:b][j[better]], cosine[better])):
                out.append(column)
        kinds = (np.int64, np.int64, np.float64)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, k), *f])) for f, k in zip(found, kinds)], names=["u", "v", "cosine"])

    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        if not table.num_rows:
            continue
        last = _starts(table)[-1]
        if last:
            yield compare(table.slice(0, last).combine_chunks())
        rest = table.slice(last).combine_chunks()
    if rest is not None and rest.num_rows:
        yield compare(rest)


def _starts(table: pa.Table) -> np.ndarray:
    """Where a new centre or seat begins."""
    centre, seat = table["centre"].to_numpy(), table["seat"].to_numpy()
    return np.flatnonzero(np.r_[True, (centre[1:] != centre[:-1]) | (seat[1:] != seat[:-1])])


class _Audit:
    """The share of true links that the lists have, from vectors whose links are counted against all rows.

    Vectors are asked in the order of a hash, until AUDIT_LINKS links have been seen or all vectors have been asked: where
    links are rare this compares many. Saturated vectors are left out, as their links are not taken from their own lists.
    """

    def __init__(self, classes: DataFrame, threshold: float):
        self.classes, self.threshold = classes.withColumn("hash", F.xxhash64(F.lit("audit"), "cid")), threshold
        self.true: dict[int, int] = {}
        self.last, self.size, self.all = None, AUDITED, False

    def recall(self, links: DataFrame) -> float:
        while True:
            seen = self._seen(links)
            there = sum(n for n, _ in seen)
            if there >= AUDIT_LINKS or self.all:
                return sum(min(n, found) for n, found in seen) / there if there else 1.0
            self._ask()

    def _seen(self, links: DataFrame) -> list[tuple[int, int]]:
        """True and found links of each vector with links whose list is not full."""
        if not self.true:
            return []
        spark = self.classes.sparkSession
        asked = spark.createDataFrame([(cid,) for cid in self.true], "u long")
        found = {r["u"]: r["found"] for r in links.join(F.broadcast(asked), "u").groupBy("u").agg(F.count(F.lit(1)).alias("found")).collect()}
        return [(n, found.get(cid, 0)) for cid, n in self.true.items() if found.get(cid, 0) < LISTED]

    def _ask(self) -> None:
        rest = self.classes
        if self.last is not None:
            rest = rest.filter((F.col("hash") > self.last[0]) | ((F.col("hash") == self.last[0]) & (F.col("cid") > self.last[1])))
        asked = rest.orderBy("hash", "cid").limit(self.size).collect()
        self.all = len(asked) < self.size
        if not asked:
            return
        self.last, self.size = (asked[-1]["hash"], asked[-1]["cid"]), min(2 * self.size, MOST_ASKED)
        by_kind: dict[str, tuple[list[int], np.ndarray]] = {}
        for kind in {r["kind"] for r in asked}:
            rows = [r for r in asked if r["kind"] == kind]
            by_kind[kind] = ([r["cid"] for r in rows], unit(pd.Series([r["vector"] for r in rows])))
        held, threshold = self.classes.sparkSession.sparkContext.broadcast(by_kind), self.threshold

        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total: dict[int, int] = {}
            for batch in batches:
                for kind, part in batch.groupby("kind"):
                    cids, x = held.value.get(kind, ([], None))
                    for at in range(0, len(part) if len(cids) else 0, BLOCK):
                        few = part.iloc[at : at + BLOCK]
                        near = x @ unit(few["vector"]).T >= threshold
                        near &= np.array(cids)[:, None] != few["cid"].to_numpy()[None, :]
                        n = near.sum(axis=1)
                        for i in np.flatnonzero(n):
                            total[cids[i]] = total.get(cids[i], 0) + int(n[i])
            if total:
                yield pd.DataFrame({"u": list(total), "n": list(total.values())})

        counted = self.classes.select("cid", "kind", "vector").mapInPandas(count, "u long, n long").groupBy("u").agg(F.sum("n").alias("n"))
        self.true |= {r["u"]: r["n"] for r in counted.collect()}
        held.destroy()


def _leaders(links: DataFrame, full: DataFrame) -> DataFrame:
    """(cid) of saturated vectors whose hash is the smallest among the saturated vectors they are linked with."""
    of = full.select("cid", F.xxhash64(F.lit("leader"), "cid").alias("hash"))
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    least = both.join(of.withColumnRenamed("cid", "v"), "v").groupBy(F.col("u").alias("cid")).agg(F.min("hash").alias("least"))
    return of.join(least, "cid", "left").filter(F.col("least").isNull() | (F.col("hash") <= F.col("least"))).orderBy("hash", "cid").limit(MOST_CELLS).select("cid")


def _forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, column) of true entries that connect all rows and columns which the true entries connect."""
    row_open, column_open = near.any(axis=1), near.any(axis=0)
    i, j = [], []
    while row_open.any():
        rows = np.array([np.argmax(row_open)])
        row_open[rows] = False
        while len(rows):
            columns = np.flatnonzero(column_open & near[rows].any(axis=0))
            column_open[columns] = False
            i.append(rows[np.argmax(near[np.ix_(rows, columns)], axis=0)])
            j.append(columns)
            others = np.flatnonzero(row_open & near[:, columns].any(axis=1))
            row_open[others] = False
            i.append(others)
            j.append(columns[np.argmax(near[np.ix_(others, columns)], axis=1)] if len(others) else others)
            rows = others
    none = np.empty(0, np.int64)
    return np.concatenate([none, *i]), np.concatenate([none, *j])


def _dense_links(members: DataFrame, leaders: DataFrame, threshold: float) -> DataFrame:
    """All links between ``members`` (cid, kind, vector, n): (cid, n_links, other), to be added up by cid.

    Rows with ``other`` are links that connect whatever links connect; pairs are counted but not written. Each vector
    belongs to the cell of its nearest leader, and the radius of a cell is its largest angle. A vector meets a cell
    only if the angle to its leader is at most the radius and the angle of the threshold, and exceeds the angle to the
    own leader by at most twice the latter: no link is outside of that. A cell that is wholly near is counted unseen.
    """
    spark = members.sparkSession
    pivots = leaders.join(members, "cid").select("cid", "kind", "vector").toPandas()
    by_kind = {kind: (part.index.to_numpy(), unit(part["vector"])) for kind, part in pivots.groupby("kind")}
    hubs, reach = pivots["cid"].to_numpy(np.int64), float(np.arccos(threshold))
    held = spark.sparkContext.broadcast(by_kind)

    def angles(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
        """Rows of one kind, few at a time, with the numbers of its cells and the angles to them."""
        for batch in batches:
            for kind, part in batch.groupby("kind"):
                cells, x = held.value.get(kind, (np.array([-1]), None))
                step = max(1, ANGLES // len(cells))
                for at in range(0, len(part), step):
                    few = part.iloc[at : at + step]
                    yield few, cells, np.zeros((len(few), 1)) if x is None else np.arccos(np.clip(unit(few["vector"]) @ x.T, -1, 1))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for few, cells, angle in angles(batches):
            own = angle.argmin(axis=1)
            yield few.assign(cell=cells[own], angle=angle[np.arange(len(few)), own])[["cid", "kind", "vector", "n", "cell", "angle"]]

    homes = staged(members.select("cid", "kind", "vector", "n").mapInPandas(assign, "cid long, kind string, vector array<double>, n long, cell int, angle double"))
    radius, weight = np.full(len(hubs), -np.inf), np.zeros(len(hubs), np.int64)
    for r in homes.filter("cell >= 0").groupBy("cell").agg(F.max("angle").alias("radius"), F.sum("n").alias("n")).collect():
        radius[r["cell"]], weight[r["cell"]] = r["radius"], r["n"]

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for few, cells, angle in angles(batches):
            cid, n, own = few["cid"].to_numpy(), few["n"].to_numpy(), few["cell"].to_numpy()
            if cells[0] < 0:
                yield pd.DataFrame({"cid": cid, "kind": few["kind"].to_numpy(), "cell": -1, "n_links": 0, "other": -1})
                continue
            r = radius[cells][None, :]
            meets = (angle <= r + reach + SLACK) & (angle <= few["angle"].to_numpy()[:, None] + 2 * reach + SLACK)
            wholly = meets & (angle + r <= reach - SLACK)
            i, j = np.nonzero(wholly)
            mine = cells[j] == own[i]
            yield pd.DataFrame({"cid": cid[i], "kind": None, "cell": None, "n_links": weight[cells[j]] - np.where(mine, n[i], 0), "other": hubs[cells[j]]})
            tight = radius[own] <= reach - SLACK
            yield pd.DataFrame({"cid": cid[tight], "kind": None, "cell": None, "n_links": 0, "other": hubs[own[tight]]})
            i, j = np.nonzero(meets & ~wholly)
            yield pd.DataFrame({"cid": cid[i], "kind": few["kind"].to_numpy()[i], "cell": cells[j], "n_links": 0, "other": -1})

    routes = staged(homes.mapInPandas(route, "cid long, kind string, cell int, n_links long, other long"))
    visits = routes.filter(F.col("cell").isNotNull()).select("cid", "kind", "cell")
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(n / BLOCK)).cast("int")
    sizes = homes.groupBy("kind", "cell").agg(blocks(F.count(F.lit(1))).alias("homes"))
    sizes = staged(sizes.join(visits.groupBy("kind", "cell").agg(blocks(F.count(F.lit(1))).alias("guests")), ["kind", "cell"]))
    guests = attach(visits, homes.select("cid", "vector", "n"), ["cid"], F.col("cell"))
    sides = []
    for side, rows, own, others in ((0, guests, "guests", "homes"), (1, homes.select("cid", "kind", "cell", "vector", "n"), "homes", "guests")):
        dealt = attach(rows, sizes, ["kind", "cell"], F.col("cid")).withColumn(own + "_at", F.pmod(F.xxhash64("cid"), F.col(own)).cast("int"))
        dealt = dealt.withColumn(others + "_at", F.explode(F.sequence(F.lit(0), F.col(others) - 1)))
        sides.append(dealt.select("kind", "cell", "homes_at", "guests_at", F.lit(side).alias("side"), "cid", "vector", "n"))

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        a, b = part[part["side"] == 0], part[part["side"] == 1]
        if not len(a) or not len(b):
            return pd.DataFrame({"cid": [], "n_links": [], "other": []})
        of_a, of_b = a["cid"].to_numpy(), b["cid"].to_numpy()
        near = (unit(a["vector"]) @ unit(b["vector"]).T >= threshold) & (of_a[:, None] != of_b[None, :])
        i, j = _forest(near)
        counts = pd.DataFrame({"cid": of_a, "n_links": near @ b["n"].to_numpy(), "other": of_a})
        return pd.concat([counts, pd.DataFrame({"cid": of_a[i], "n_links": 0, "other": of_b[j]})])

    met = sides[0].unionByName(sides[1]).groupBy("kind", "cell", "homes_at", "guests_at").applyInPandas(compare, "cid long, n_links long, other long")
    return met.unionByName(routes.filter(F.col("cell").isNull()).select("cid", "n_links", "other"))


def _search(searched: DataFrame, threshold: float, seed: int) -> tuple[DataFrame, bool]:
    """The lists, and whether they fell short of RECALL, so that all vectors have to be compared."""
    lists, audit = staged(_lists(_first_graph(searched, seed))), _Audit(searched, threshold)
    turn, short, held = 0, 0, -1
    while True:
        found = _refine(lists, searched, turn)
        if turn >= ROUNDS:
            found = found.unionByName(_first_graph(searched, seed + turn))
        refined = staged(_lists(lists.unionByName(found)))
        drop_staged(lists)
        lists, turn = refined, turn + 1
        if turn < ROUNDS:
            continue
        links = lists.filter(F.col("cosine") >= threshold)
        before, held = held, links.count()
        if turn > ROUNDS and held - before > GAIN * held:
            continue
        if audit.recall(links) >= RECALL:
            return lists, False
        short += 1
        if short > MORE_ROUNDS:
            return lists, True


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, seed: int = 5) -> DataFrame:
    """(vec_id, n_links, component_id) for every row of (vec_id, embedding, label).

    Two rows are linked when they have one label and one length and a cosine, in double precision, of at least
    ``threshold``. Rows without label, and vectors that are null, empty, zero or hold a null or non-finite component, link with
    nothing. Equal vectors form one class, that is searched once and counted with all its rows; rows may repeat. A null
    vec_id is a vector of its own, and never the name of a component that has another. Other columns are not read.

    The neighbour graph starts from random hyperplanes and is refined in rounds, until a round adds few links and an
    audit against all rows finds RECALL of them. After MORE_ROUNDS audits in vain all vectors are compared. Lists have LISTED entries. Where all entries of a list are links it is saturated; links
    between saturated vectors are all found by comparing cells of them, whatever the lists say; nothing is cut off.
    """
    ship(vectors.sparkSession)
    rows = vectors.select("vec_id", "embedding", "label", F.coalesce(F.col("vec_id").cast("long"), F.monotonically_increasing_id() + F.lit(NO_ID)).alias("id"))
    known = staged(_usable(rows).withColumn("class", F.sha2(F.to_json(F.struct("kind", "vector")), 256)))
    usable = known.filter(F.col("kind").isNotNull())
    classes = staged(usable.groupBy("class").agg(F.min("id").alias("cid"), F.count(F.lit(1)).alias("n"), F.first("kind").alias("kind"), F.first("vector").alias("vector")))
    searched = classes.select("cid", "kind", "vector")

    lists, whole = _search(searched, threshold, seed)
    links = lists.filter(F.col("cosine") >= threshold).select("u", "v")

    full = links.groupBy("u").count().filter(F.col("count") >= LISTED).select(F.col("u").alias("cid"))
    full = staged(classes.select("cid") if whole else full)
    dense = staged(_dense_links(classes.join(full, "cid", "left_semi"), _leaders(links, full), threshold))
    counted = dense.groupBy("cid").agg(F.sum("n_links").alias("n_links"))

    # A list that is not full has all links of its vector, so links that have one such end are counted from the lists.
    known_full = staged(classes.join(full.withColumn("yes", F.lit(True)), "cid", "left").select("cid", "n", F.coalesce("yes", F.lit(False)).alias("full")))
    both = staged(links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    ends = attach(both, known_full.select(F.col("cid").alias("v"), "n", F.col("full").alias("full_v")), ["v"], F.col("u"))
    ends = attach(ends, known_full.select(F.col("cid").alias("u"), F.col("full").alias("full_u")), ["u"], F.col("v"))
    listed = ends.filter("not (full_u and full_v)").groupBy(F.col("u").alias("cid")).agg(F.sum("n").alias("listed"))

    edges = links.unionByName(dense.select(F.col("cid").alias("u"), F.col("other").alias("v")))
    roots = staged(components(edges.select(F.col("u").alias("a"), F.col("v").alias("b"))))
    rooted = classes.select("cid", "n", "class").join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    per_class = (
        rooted.join(listed, "cid", "left")
        .join(counted, "cid", "left")
        .select("class", F.col("root").alias("component"), (F.col("n") - 1 + F.coalesce("n_links", F.lit(0)) + F.coalesce("listed", F.lit(0))).alias("n_links"))
    )
    linked = attach(usable.select("id", "class"), staged(per_class), ["class"], F.col("id"))
    alone = known.filter(F.col("kind").isNull()).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    every = linked.select("id", "n_links", "component").unionByName(alone)
    named = lambda c: F.when(F.col(c) < NO_ID, F.col(c))
    return every.select(named("id").alias("vec_id"), F.col("n_links").cast(T.LongType()).alias("n_links"), named("component").alias("component_id"))
