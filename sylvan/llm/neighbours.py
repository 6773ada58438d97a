"""Approximate nearest neighbours by inner product: NN-descent builds a
neighbour graph, queries search it greedily.

1. Equal vectors become one node; only the different ids that
   can appear in a result (the smallest k + 1) are kept with it, so a vector
   that a third of the rows share is one node.
2. First lists: several random orders (signs of random projections, then one
   projection) put likely neighbours side by side; runs of ``RUN`` nodes are
   compared among themselves.
3. NN-descent: neighbours of neighbours are likely neighbours. Each round, every
   node brings together its list and a bounded sample of the nodes that list
   it, and compares these members with each other where at least one of the
   two is new to the list. Improvements go to the members, whose lists keep the best
   ``width``. Rounds end when few entries change (a share under
   ``LEAST_CHANGE``), however many that takes. Lists and vectors meet by
   joins in blocks of ``BLOCK`` nodes that are near in a random order: a
   member's vector travels once for each block that needs it, the finds of one
   block for another travel in one row, and a task holds one block.
4. Search: a query is a row of the table and starts from its own node's list;
   each round expands the best nodes not yet expanded, scores
   their neighbours in double precision and keeps the best ``beam``. A query
   is done when all nodes of its beam are expanded; only the others go into the
   next round. Rounds are joins again, in blocks of queries.

Both kinds of rounds end by themselves: lists and beams only get better, and a
node that left a beam cannot come back. ``SAFETY_ROUNDS`` raises an error.

Graph building compares vectors rounded to 8 bits; scores of the search and of
results are exact, from the original vectors in their own type (float or
double). Recall is measured against brute
force by ``recall_against_brute_force``.

Corner cases: vectors that are null, empty, zero, or hold null or non-finite
components take no part, neither do vectors of another length than the most
frequent one; null ids take no part; repeated rows count once. An id with several
vectors is searched for with each of them, and is a neighbour once, by its best
score.
Fewer candidates than k give fewer rows. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sylvan.operators.ordering import with_global_position
from sylvan.session import Scratch

WIDTH = 40  # neighbours in a node's list
REVERSE = 40  # sampled nodes that list a node
RUN, ORDERS, CODE_BITS = 64, 4, 12
BLOCK = 4096  # nodes in a block; queries in a block: a fourth
LEAST_CHANGE = 0.005
EXPAND, BEAM = 32, 160
SAFETY_ROUNDS = 200  # reaching it is an error, never a result

LISTS = "id long, ids array<long>, sims array<float>"
NODES = "id long, block int, code binary, scale float, ids array<long>, sims array<float>, fresh array<boolean>"


def usable(vector: str) -> Column:
    """Neither null, empty nor zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def distinct_vectors(table: DataFrame, id_col: str, vector_col: str, k: int, scratch: Scratch) -> tuple[DataFrame, DataFrame, int]:
    """Nodes (id, vector, key: the smallest vec_id), their members (id, vec_id: the k + 1 smallest) and
    the vectors' length. Nodes are named by a number of their own: an id may
    have several vectors."""
    rows = table.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector")).where(
        F.col("vec_id").isNotNull() & usable("vector")
    )
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    size = lengths[0]["n"] if lengths else 0
    rows = rows.where(F.size("vector") == size).distinct()
    same = Window.partitionBy("vector").orderBy("vec_id")
    # a limit on the rank is applied before the shuffle, so no vector is hot
    ranked = rows.withColumn("rank", F.row_number().over(same)).where(F.col("rank") <= k + 1)
    named = ranked.withColumn("own", F.monotonically_increasing_id())
    members = scratch.save(named.withColumn("id", F.min("own").over(Window.partitionBy("vector"))).drop("own"), "members")
    return members.where("rank = 1").select("id", "vector", F.col("vec_id").alias("key")), members.select("id", "vec_id"), size


def _directions(size: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((size, CODE_BITS + 1)).astype(np.float32)


def _matrix(column: pd.Series, size: int) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64).reshape(-1, size)


def vector_kind(rows: DataFrame, column: str) -> str:
    """The numpy type that holds a vector column's components exactly."""
    return "float32" if rows.schema[column].dataType.elementType.typeName() == "float" else "float64"


def order_keys(nodes: DataFrame, size: int, seed: int) -> DataFrame:
    """The nodes with 8-bit vectors and their places in the random orders:
    ``key0`` for the blocks, the others for first lists."""
    schema = "id long, code binary, scale float, " + ", ".join(f"key{t} double" for t in range(ORDERS))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes = [_directions(size, seed + t) for t in range(ORDERS)]
        for batch in batches:
            x = _matrix(batch["vector"], size)
            largest = np.abs(x).max(axis=1)
            x = x / largest[:, None]  # no component too large or small for a float
            codes = np.rint(x * 127).astype(np.int8)
            scale = np.clip(largest / 127, 1e-15, 1e15)
            unit = x / np.linalg.norm(x, axis=1, keepdims=True)
            out = {"id": batch["id"], "code": [c.tobytes() for c in codes], "scale": scale}
            for t, plane in enumerate(planes):
                at = unit @ plane
                bits = (at[:, :CODE_BITS] > 0) @ (1 << np.arange(CODE_BITS))
                out[f"key{t}"] = bits + np.clip(at[:, CODE_BITS] / 40 + 0.5, 0, 0.999)
            yield pd.DataFrame(out)

    return nodes.mapInPandas(work, schema)


def _codes(batch: pd.DataFrame) -> np.ndarray:
    raw = np.frombuffer(b"".join(batch["code"]), dtype=np.int8).reshape(len(batch), -1)
    return raw.astype(np.float32) * batch["scale"].to_numpy(dtype=np.float32)[:, None]


def first_lists(keyed: DataFrame, width: int, order: int) -> DataFrame:
    """Lists from runs of one order."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x, ids = _codes(batch), batch["id"].to_numpy()
            rows = []
            for a in range(0, len(ids), RUN):
                own, some = ids[a : a + RUN], x[a : a + RUN]
                sims = some @ some.T
                np.fill_diagonal(sims, -np.inf)
                best = np.argsort(-sims, axis=1)[:, : min(width, len(own) - 1)]
                rows += [(u, own[b], s[b]) for u, b, s in zip(own, best, sims)]
            yield pd.DataFrame(rows, columns=["id", "ids", "sims"])

    key = f"key{order}"
    placed = keyed.select("id", "code", "scale", key).repartitionByRange(key, "id").sortWithinPartitions(key, "id")
    return placed.select("id", "code", "scale").mapInPandas(work, LISTS)


def deliver(needed: DataFrame, table: DataFrame, columns: dict[str, str]) -> DataFrame:
    """What blocks ask for, in one row for each pair of blocks: ``needed`` (at,
    id) are met by the rows of ``table`` in the block of that id. ``columns``
    (column: numpy type) are packed in the order of the ids."""
    home = F.floor(F.col("id") / BLOCK).cast("int").alias("home")
    asked = needed.distinct().groupBy(home, "at").agg(F.collect_list("id").alias("wanted"))  # BLOCK ids at most

    def pack(rows: pd.DataFrame, requests: pd.DataFrame) -> pd.DataFrame:
        names = rows["id"].to_numpy()
        order = np.argsort(names, kind="stable")
        out = []
        for at, wanted in zip(requests["at"], requests["wanted"]):
            wanted = np.sort(np.asarray(wanted, dtype=np.int64))
            some = rows.iloc[order[np.searchsorted(names[order], wanted)]]
            packed = [
                b"".join(some[c]) if kind == "bytes" else np.array(some[c].tolist(), dtype=kind).tobytes()
                for c, kind in columns.items()
            ]
            out.append((at, wanted.tobytes(), *packed))
        return pd.DataFrame(out, columns=["at", "id", *columns])

    held = table.select("id", *columns, F.floor(F.col("id") / BLOCK).cast("int").alias("held"))
    schema = "at int, id binary, " + ", ".join(f"{c} binary" for c in columns)
    return held.groupBy("held").cogroup(asked.groupBy("home")).applyInPandas(pack, schema)


def _unpack(rows: pd.DataFrame, **kinds) -> list[np.ndarray]:
    """Ids in ascending order and the packed columns (flat) in that order."""
    rows = rows.assign(first=[int(np.frombuffer(x, dtype=np.int64)[0]) for x in rows["id"]]).sort_values("first")
    whole = {"id": np.int64} | kinds
    return [np.frombuffer(b"".join(rows[c]), dtype=kind) for c, kind in whole.items()]


def merge_first(nodes: DataFrame, found: DataFrame, width: int) -> DataFrame:
    """Nodes with the best ``width`` entries of their first lists, all fresh."""
    # one list for each order
    gathered = found.groupBy("id").agg(F.flatten(F.collect_list("ids")).alias("ids"), F.flatten(F.collect_list("sims")).alias("sims"))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for ids, sims in zip(batch["ids"], batch["sims"]):
                ids, first = np.unique(np.asarray([] if ids is None else ids, dtype=np.int64), return_index=True)
                sims = np.asarray([] if sims is None else sims, dtype=np.float32)[first]
                best = np.lexsort((ids, -sims))[:width]
                out.append((ids[best], sims[best], np.ones(len(best), dtype=bool)))
            lists = pd.DataFrame(out, columns=["ids", "sims", "fresh"], index=batch.index)
            yield pd.concat([batch[["id", "block", "code", "scale"]], lists], axis=1)

    return nodes.join(gathered, "id", "left").mapInPandas(work, NODES)


def _ranks(groups: np.ndarray) -> np.ndarray:
    """Place of each entry in its run of equal ``groups``."""
    starts = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
    return np.arange(len(groups)) - np.repeat(starts, np.diff(np.append(starts, len(groups))))


def _compare(centres: pd.DataFrame, members: pd.DataFrame, width: int) -> pd.DataFrame:
    """One block: for each centre compare its members; per member the best
    finds that beat the worst entry of its list, packed by the member's block."""
    if not len(centres) or not len(members):
        return pd.DataFrame({"home": [], "member": [], "other": [], "sim": []})
    ids, codes, scale, worst = _unpack(members, code=np.int8, scale=np.float32, worst=np.float32)
    home = ids // BLOCK
    x = codes.reshape(len(ids), -1).astype(np.float32) * scale[:, None]
    pending: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def reduce(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        pairs, first = np.unique(np.concatenate([p for p, _ in parts]), return_index=True)
        sims = np.concatenate([s for _, s in parts])[first]
        best = np.lexsort((-sims, pairs // len(ids)))
        kept = best[_ranks((pairs // len(ids))[best]) < width] if len(best) else best
        return pairs[kept], sims[kept]

    for near, fresh in zip(centres["members"], centres["fresh"]):
        near, new = np.asarray(near, dtype=np.int64), np.asarray(fresh, dtype=bool)
        some, place = np.unique(near, return_inverse=True)  # a node may stand on both sides
        new = np.bincount(place, weights=new) > 0
        at = np.searchsorted(ids, some)
        rows = x[at]
        sims = rows @ rows.T
        better = (sims > worst[at][:, None]) & (new[:, None] | new[None, :])
        np.fill_diagonal(better, False)
        a, b = np.nonzero(better)
        pending.append((at[a].astype(np.int64) * len(ids) + at[b], sims[a, b]))
        size += len(a)
        if size > 1_500_000:
            pending = [reduce(pending)]
            size = len(pending[0][0])
    pairs, sims = reduce(pending)
    who, other = pairs // len(ids), ids[pairs % len(ids)]
    out = []
    for block in np.unique(home[who]):
        of = home[who] == block
        out.append((block, ids[who[of]].tobytes(), other[of].tobytes(), sims[of].astype(np.float32).tobytes()))
    return pd.DataFrame(out, columns=["home", "member", "other", "sim"])


FINDS = "home int, member binary, other binary, sim binary"


def _renew(nodes: pd.DataFrame, finds: pd.DataFrame, width: int) -> pd.DataFrame:
    """One block's nodes: the best ``width`` of old and found entries; entries
    that were not there are fresh."""
    names = nodes["id"].to_numpy()
    order = np.argsort(names, kind="stable")
    sizes = np.fromiter(map(len, nodes["ids"]), dtype=np.int64, count=len(nodes))
    who = [np.repeat(np.arange(len(nodes)), sizes)]
    other = [np.concatenate([np.asarray(x, dtype=np.int64) for x in nodes["ids"]])] if len(nodes) else [np.zeros(0, dtype=np.int64)]
    sim = [np.concatenate([np.asarray(x, dtype=np.float32) for x in nodes["sims"]])] if len(nodes) else [np.zeros(0, dtype=np.float32)]
    for member, found, value in zip(finds["member"], finds["other"], finds["sim"]):
        who.append(order[np.searchsorted(names[order], np.frombuffer(member, dtype=np.int64))])
        other.append(np.frombuffer(found, dtype=np.int64))
        sim.append(np.frombuffer(value, dtype=np.float32))
    fresh = np.arange(sum(map(len, who))) >= len(who[0])
    who, other, sim = np.concatenate(who), np.concatenate(other), np.concatenate(sim)
    once = np.lexsort((fresh, other, who))  # an old entry before a find of the same
    first = np.append(True, (who[once][1:] != who[once][:-1]) | (other[once][1:] != other[once][:-1]))[: len(once)]
    once = once[first]
    best = once[np.lexsort((other[once], -sim[once], who[once]))]
    best = best[_ranks(who[best]) < width] if len(best) else best
    cuts = np.searchsorted(who[best], np.arange(1, len(nodes)))
    lists = {"ids": np.split(other[best], cuts), "sims": np.split(sim[best], cuts), "fresh": np.split(fresh[best], cuts)}
    return nodes[["id", "block", "code", "scale"]].assign(**{k: pd.Series(v, index=nodes.index, dtype=object) for k, v in lists.items()})


def descend(nodes: DataFrame, width: int, reverse: int, turn: int) -> DataFrame:
    """One round: the nodes with renewed lists."""
    listed = nodes.select("id", F.explode(F.arrays_zip("ids", "fresh")).alias("e"))
    listed = listed.select("id", F.col("e.ids").alias("other"), F.col("e.fresh").alias("fresh"))
    # who lists a node: a sample, new ones first; the rank limit holds before the shuffle
    dealt = Window.partitionBy("other").orderBy(F.desc("fresh"), F.xxhash64("id", F.lit(turn)), "id")
    listing = listed.withColumn("rank", F.row_number().over(dealt)).where(F.col("rank") <= reverse)
    both = listed.select(F.col("id").alias("centre"), F.col("other").alias("member"), "fresh").unionByName(
        listing.select(F.col("other").alias("centre"), F.col("id").alias("member"), "fresh")
    )
    centres = (
        both.groupBy("centre")  # width + reverse at most
        .agg(F.collect_list("member").alias("members"), F.collect_list("fresh").alias("fresh"), F.max("fresh").alias("any"))
        .where("any")
        .select(F.floor(F.col("centre") / BLOCK).cast("int").alias("block"), "members", "fresh")
    )
    needed = centres.select(F.col("block").alias("at"), F.explode("members").alias("id"))
    worst = F.when(F.size("sims") >= width, F.array_min("sims")).otherwise(F.lit(float("-inf")).cast("float"))
    vectors = deliver(needed, nodes.select("id", "code", "scale", worst.alias("worst")), {"code": "bytes", "scale": "float32", "worst": "float32"})
    finds = centres.groupBy("block").cogroup(vectors.groupBy("at")).applyInPandas(lambda c, m: _compare(c, m, width), FINDS)
    return nodes.groupBy("block").cogroup(finds.groupBy("home")).applyInPandas(lambda n, f: _renew(n, f, width), NODES)


def neighbour_graph(
    nodes: DataFrame, size: int, scratch: Scratch, width: int = WIDTH, reverse: int = REVERSE, seed: int = 1
) -> tuple[DataFrame, DataFrame]:
    """NN-descent: a written table of NODES, and (id, name) for its ids, where
    ``name`` is the id that ``nodes`` has. A node's id is its place in the first random order, so that its block, a run
    of ``BLOCK`` places, is known from the id alone."""
    placed, _ = with_global_position(order_keys(nodes, size, seed), ["key0", "id"], position="at")
    keyed = scratch.save(placed.withColumnRenamed("id", "name").withColumn("id", F.col("at") - 1).drop("at"), "keyed")
    bare = keyed.select("id", F.floor(F.col("id") / BLOCK).cast("int").alias("block"), "code", "scale")
    found = first_lists(keyed, width, 0)
    for order in range(1, ORDERS):
        found = found.unionByName(first_lists(keyed, width, order))
    graph = scratch.save(merge_first(bare, found, width), "graph-0")
    for turn in range(1, SAFETY_ROUNDS + 1):
        following = scratch.save(descend(graph, width, reverse, turn), f"graph-{turn}")
        scratch.drop(f"graph-{turn - 1}")
        graph = following
        row = graph.agg(F.sum(F.size(F.filter("fresh", lambda x: x))), F.sum(F.size("ids"))).first()
        if (row[0] or 0) <= LEAST_CHANGE * (row[1] or 1):
            break
    else:
        raise RuntimeError(f"neighbour lists not settled after {SAFETY_ROUNDS} rounds")
    return graph, keyed.select("id", "name")


BEAMS = "query long, block int, ids array<long>, keys array<long>, sims array<double>, done array<boolean>"


def _advance(state: pd.DataFrame, vectors: pd.DataFrame, size: int, beam: int, kind: str) -> pd.DataFrame:
    """One block of queries: score the candidates, keep the best ``beam``; of
    equal scores those with the smallest keys."""
    if not len(state):
        return state[["query", "block"]].assign(ids=[], keys=[], sims=[], done=[])
    none = np.zeros(0, dtype=np.int64)
    names, x, key = _unpack(vectors, vector=kind, key=np.int64) if len(vectors) else (none, np.zeros(0), none)
    x = x.reshape(-1, size).astype(np.float64)
    out = []
    for query, block, vector, ids, keys, sims, done, new in zip(
        *(state[c] for c in ("query", "block", "vector", "ids", "keys", "sims", "done", "new"))
    ):
        ids, keys = np.asarray(ids, dtype=np.int64), np.asarray(keys, dtype=np.int64)
        sims, done = np.asarray(sims, dtype=np.float64), np.asarray(done, dtype=bool)
        if new is not None and len(new):
            new = np.setdiff1d(np.asarray(new, dtype=np.int64), ids)
            at = np.searchsorted(names, new)
            scores = x[at] @ np.asarray(vector, dtype=np.float64)
            ids, keys, sims = np.concatenate([ids, new]), np.concatenate([keys, key[at]]), np.concatenate([sims, scores])
            done = np.concatenate([done, np.zeros(len(new), dtype=bool)])
        best = np.lexsort((ids, keys, -sims))[:beam]
        out.append((query, block, ids[best], keys[best], sims[best], done[best]))
    return pd.DataFrame(out, columns=["query", "block", "ids", "keys", "sims", "done"])


def search_graph(
    queries: DataFrame, graph: DataFrame, nodes: DataFrame, size: int, scratch: Scratch,
    expand: int = EXPAND, beam: int = BEAM,
) -> DataFrame:
    """Greedy search until every node of every beam is expanded. ``queries``:
    query, vector, block, ``start`` (node ids); ``nodes``: id, vector, ``key``
    (the smallest vec_id, which decides ties). Rows of BEAMS, best nodes first."""
    queries = queries.select("query", "block", "vector", "start")
    vectors = nodes.select("id", "vector", "key")
    kind = vector_kind(nodes, "vector")

    def step(state: DataFrame, name: str) -> DataFrame:
        """``state``: BEAMS columns, vector and ``new`` candidates."""
        state = scratch.save(state, f"{name}-todo")
        needed = deliver(state.select(F.col("block").alias("at"), F.explode("new").alias("id")), vectors, {"vector": kind, "key": "int64"})
        moved = state.groupBy("block").cogroup(needed.groupBy("at")).applyInPandas(
            lambda s, v: _advance(s, v, size, beam, kind), BEAMS
        )
        moved = scratch.save(moved, name)
        scratch.drop(f"{name}-todo")
        return moved

    unfinished = F.exists("done", lambda d: ~d)
    none = [F.array().cast(f"array<{t}>").alias(n) for n, t in (("ids", "long"), ("keys", "long"), ("sims", "double"), ("done", "boolean"))]
    beams = step(queries.select("query", "block", "vector", *none, F.col("start").alias("new")), "beam-0")
    finished = beams.where(~unfinished)
    for turn in range(1, SAFETY_ROUNDS + 1):
        beams = beams.where(unfinished)
        if beams.isEmpty():
            break
        entries = F.transform(F.arrays_zip("ids", "done"), lambda e, i: F.struct(i.alias("i"), e["ids"].alias("id"), e["done"].alias("done")))
        chosen = F.slice(F.filter(entries, lambda e: ~e["done"]), 1, expand)
        open_ = beams.withColumn("chosen", F.transform(chosen, lambda e: e["id"]))
        reached = (
            open_.select("query", F.explode("chosen").alias("id")).join(graph.select("id", F.col("ids").alias("next")), "id")
            .groupBy("query").agg(F.array_distinct(F.flatten(F.collect_list("next"))).alias("reached"))  # expand * width at most
        )
        done = F.zip_with("ids", "done", lambda i, d: d | F.array_contains("chosen", i))
        state = (
            open_.join(reached, "query", "left").join(queries.select("query", "vector"), "query")
            .select(
                "query", "block", "vector", "ids", "keys", "sims", done.alias("done"),
                F.array_except(F.coalesce("reached", F.array().cast("array<long>")), F.col("ids")).alias("new"),
            )
        )
        beams = step(state, f"beam-{turn}")
        finished = finished.unionByName(beams.where(~unfinished))
    else:
        raise RuntimeError(f"search not settled after {SAFETY_ROUNDS} rounds")
    return finished


def nearest(
    table: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 1
) -> DataFrame:
    """For each row of ``table`` that ``is_query`` marks (a condition on its
    id): its ``k`` nearest other rows found, as query_id, rank, vec_id, score."""
    spark = table.sparkSession
    scratch = Scratch(spark, "neighbours")
    nodes, members, size = distinct_vectors(table, id_col, vector_col, k, scratch)
    # lists and beams are wide enough for any k
    beam = max(BEAM, 2 * (k + 1))
    graph, numbers = neighbour_graph(nodes.drop("key"), size, scratch, width=max(WIDTH, k + 1), seed=seed)
    # from here on a node goes by its number
    numbers = numbers.withColumnRenamed("id", "number")
    renamed = lambda df: df.join(numbers.withColumnRenamed("name", "id"), "id").drop("id").withColumnRenamed("number", "id")
    nodes, members = scratch.save(renamed(nodes), "numbered-nodes"), scratch.save(renamed(members), "numbered-members")

    # queries by node: rows of one vector are searched for once
    rows = table.select(F.col(id_col), F.col(vector_col).alias("vector")).where(
        is_query & F.col(id_col).isNotNull() & usable("vector") & (F.size("vector") == size)
    )
    asked = rows.select(F.col(id_col).alias("query_id"), "vector").join(nodes, "vector").select("query_id", "id").distinct()
    asked = scratch.save(asked, "asked")
    wanted = asked.select("id").distinct()
    start = F.concat(F.array("id"), "ids").alias("start")
    queries = graph.join(wanted, "id", "left_semi").join(nodes, "id").select(
        F.col("id").alias("query"), F.floor(F.col("block") / 4).cast("int").alias("block"), "vector", start
    )
    beams = search_graph(scratch.save(queries, "queries"), graph, nodes, size, scratch, max(EXPAND, beam // 5), beam)
    # the k + 1 best ids of each searched node, its own row among them; nodes
    # may share ids, so all of the beam counts
    hits = beams.select("query", F.explode(F.arrays_zip("ids", "sims")).alias("h")).select(
        "query", F.col("h.ids").alias("id"), F.col("h.sims").alias("score")
    )
    ids = hits.join(members, "id").groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ids = ids.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= k + 1)
    best = ids.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("best"))
    own = asked.join(best, asked["id"] == best["query"])
    others = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)
    return own.select("query_id", F.posexplode(others).alias("pos", "b")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score")
    )


def recall_against_brute_force(found: DataFrame, table: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> float:
    """Share of the true ``k`` nearest found, for a stated query set (which is
    handed to every task): each task keeps its best k, the best of all count."""
    rows = table.where(F.col(id_col).isNotNull() & usable(vector_col)).select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"))
    asked = rows.where(is_query).toPandas()
    size = len(asked["vector"].iloc[0])
    q, names = _matrix(asked["vector"], size), asked["vec_id"].to_numpy()

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = batch["vec_id"].to_numpy()
            scores = q @ _matrix(batch["vector"], size).T
            scores[names[:, None] == ids[None, :]] = -np.inf
            best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            yield pd.DataFrame({
                "query_id": np.repeat(names, best.shape[1]), "vec_id": ids[best].ravel(),
                "score": np.take_along_axis(scores, best, axis=1).ravel(),
            })

    all_ = rows.mapInPandas(work, "query_id long, vec_id long, score double").where(F.col("score") > float("-inf"))
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    true = all_.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    hit = true.join(found.select("query_id", "vec_id").withColumn("hit", F.lit(1)), ["query_id", "vec_id"], "left")
    row = hit.agg(F.sum(F.coalesce("hit", F.lit(0))), F.count(F.lit(1))).first()
    return row[0] / row[1] if row[1] else 1.0
