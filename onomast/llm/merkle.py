"""Merkle manifests of tables: one tree a group over its rows in order, one tree over the groups.

A node's digest is the SHA-256 (lowercase hex) of its children's digests in hex, joined; ``FAN`` consecutive nodes have one parent, a last run
of fewer (even one) too, until one node is left. Rows get their places within their group without any group in one task: leaves are
dealt by range, counted a range, and the counts added up. Places are cut into blocks of ``FAN ** DEPTH`` aligned leaves, and a task's
blocks go as Arrow tables through DuckDB, which works a level of them with one query: ``string_agg`` in order, then ``sha256``. So a
block becomes one node, and blocks of blocks are worked likewise until each group has its root, then over the groups' roots.

Proofs go down again: a block's own proof (the siblings of its ancestors) is joined to its nodes by one row a block, whatever the number
of nodes. Only leaves with their digests are shuffled, never proofs of rows: DuckDB hashes those where it makes them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from onomast.llm.common import discard, stored

FAN, DEPTH = 16, 3
#: Rows that go through one call of the engine at most, besides those of the last block.
_ROWS = 1 << 15
_STEPS = "array<struct<left:string,right:string>>"
#: What goes through the engine: nodes (kind 0) and one row a block (kind 1) with the block's own proof and its group's root.
_GIVEN = {"grp": "bigint", "block": "bigint", "kind": "int", "place": "bigint", "n": "bigint", "digest": "string", "other": "string", "id": "bigint", "steps": _STEPS, "top": "string"}
_ROOTS = {"grp": "bigint", "place": "bigint", "n": "bigint", "digest": "string"}
_PROOFS = {"grp": "bigint", "place": "bigint", "steps": _STEPS, "top": "string"}


def field(c: Column) -> Column:
    """A value as it is hashed: ``-`` for null, else its length in bytes as UTF-8, a colon and itself."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def placed(leaves: DataFrame, key: str) -> DataFrame:
    """``leaves`` (a stored table dealt by :func:`dealt`) with ``grp`` (the key's number in order), ``n`` (rows of the key) and ``place`` (0-based).

    Counts have a row for each key and range that meet, at most as many as keys and ranges together; windows over them see the
    ranges of one key, and of keys the first of each range.
    """
    part, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = leaves.groupBy(F.col(key).alias("_key"), part.alias("_part")).agg(F.count(F.lit(1)).alias("_count"), F.min(row).alias("_first"))
    own = Window.partitionBy("_key")
    counts = counts.withColumn("_before", F.sum("_count").over(own.orderBy("_part")) - F.col("_count")).withColumn("_n", F.sum("_count").over(own)).withColumn("_lead", (F.min("_part").over(own) == F.col("_part")).cast("long"))
    counts = stored(counts, "counts")
    # keys are numbered by the range in which each begins, there by their order
    heads = counts.where("_lead = 1")
    per = heads.groupBy("_part").agg(F.count(F.lit(1)).alias("_keys"))
    starts = per.withColumn("_base", F.sum("_keys").over(Window.orderBy("_part")) - F.col("_keys")).drop("_keys")  # one row a range
    numbered = heads.withColumn("_no", F.row_number().over(Window.partitionBy("_part").orderBy("_first")) - 1).join(starts, "_part").select(F.col("_key").alias("_name"), (F.col("_base") + F.col("_no")).alias("grp"))
    spans = stored(counts.join(numbered, F.col("_key").eqNullSafe(F.col("_name"))).select("_key", F.col("_part").alias("_range"), "_first", "_before", "_n", "grp"), "spans")
    discard(counts)
    joined = leaves.withColumn("_part", part).join(spans, (F.col("_part") == F.col("_range")) & F.col(key).eqNullSafe(F.col("_key")))
    return joined.select("grp", F.col("_n").alias("n"), (F.col("_before") + row - F.col("_first")).alias("place"), *[c for c in leaves.columns if c != "_at"])


def dealt(rows: DataFrame, order: list[Column]) -> DataFrame:
    """The rows in order over ranges, as a stored table with ``_at``: range and row in it."""
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ranges.withColumn("_at", F.monotonically_increasing_id()), "leaves")


class _Engine:
    """DuckDB over the blocks of one task."""

    def __init__(self, depth: int):
        import duckdb

        self.depth = depth
        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "512MB"})

    def load(self, nodes: pa.Table) -> None:
        """Nodes of whole blocks; ``depth`` is the number of levels that a block still goes up."""
        depth = " + ".join(f"(n > {FAN**k})::INT" for k in range(self.depth))
        self.con.register("given", nodes)
        self.con.execute(f"CREATE OR REPLACE TEMP TABLE level0 AS SELECT grp, block, place % {FAN**self.depth} AS i, {depth} AS depth, digest AS d FROM given WHERE kind = 0")
        for k in range(self.depth):
            # a run's text has the digests of its nodes in order; its hash is their parent
            self.con.execute(f"CREATE OR REPLACE TEMP TABLE run{k} AS SELECT grp, block, i // {FAN} AS i, depth, string_agg(d, '' ORDER BY i) AS run FROM level{k} WHERE depth > {k} GROUP BY ALL")
            self.con.execute(f"CREATE OR REPLACE TEMP TABLE level{k + 1} AS SELECT grp, block, i, depth, sha256(run) AS d FROM run{k} UNION ALL SELECT grp, block, i, depth, d FROM level{k} WHERE depth <= {k}")

    def roots(self) -> pa.Table:
        """One node a block, of the table above."""
        return self._got(f"SELECT l.grp, l.block AS place, s.n, l.d AS digest FROM level{self.depth} l JOIN (SELECT grp, block, (any_value(n) + {FAN**self.depth - 1}) // {FAN**self.depth} AS n FROM given GROUP BY ALL) s ON s.grp = l.grp AND s.block = l.block")

    def _got(self, query: str) -> pa.Table:
        return self.con.sql(query).to_arrow_table()

    def _paths(self) -> str:
        """Each node of kind 0 with what stands left and right of it and of its ancestors in their runs; empty above the top."""
        cols, joins = [], []
        for k in range(self.depth):
            at = f"64 * (place // {FAN**k} % {FAN})"
            cols += [f"coalesce(substr(r{k}.run, 1, {at}), '') AS l{k}", f"coalesce(substr(r{k}.run, {at} + 65), '') AS r{k}", f"r{k}.run IS NOT NULL AS up{k}"]
            joins.append(f"LEFT JOIN run{k} r{k} ON r{k}.grp = g.grp AND r{k}.block = g.block AND r{k}.i = g.place % {FAN**self.depth} // {FAN ** (k + 1)}")
        return f"SELECT g.*, {', '.join(cols)} FROM given g {' '.join(joins)} WHERE kind = 0"

    def steps(self) -> pa.Table:
        """The whole proof of each node, as steps from its level upwards."""
        own = " || ".join(f"CASE WHEN up{k} THEN [{{'left': l{k}, 'right': r{k}}}] ELSE [] END" for k in range(self.depth))
        return self._got(f"SELECT p.grp, p.place, {own} || o.steps AS steps, coalesce(o.top, '') AS top FROM ({self._paths()}) p JOIN given o ON o.kind = 1 AND o.grp = p.grp AND o.block = p.block")

    def proofs(self) -> pa.Table:
        """For each leaf the hash of its proof, and the root that another leaf in its place would lead to."""
        self.con.execute("CREATE OR REPLACE TEMP TABLE outer_steps AS SELECT grp, block, unnest(range(len(steps))) AS no, unnest(steps) AS s FROM given WHERE kind = 1 AND len(steps) > 0")
        self.con.execute("CREATE OR REPLACE TEMP TABLE tops AS SELECT o.grp, o.block, any_value(o.top) AS top, coalesce(string_agg(s.s.left || s.s.right, '' ORDER BY s.no), '') AS beyond FROM given o LEFT JOIN outer_steps s ON s.grp = o.grp AND s.block = o.block WHERE o.kind = 1 GROUP BY ALL")
        text = " || ".join(f"l{k} || r{k}" for k in range(self.depth))
        fold = "other"
        for k in range(self.depth):
            fold = f"CASE WHEN up{k} THEN sha256(l{k} || {fold} || r{k}) ELSE {fold} END"
        self.con.execute(f"CREATE OR REPLACE TEMP TABLE folds AS SELECT p.id, p.digest, p.grp, p.block, t.top, sha256({text} || t.beyond) AS proof, CASE WHEN other IS NOT NULL THEN {fold} END AS f FROM ({self._paths()}) p JOIN tops t ON t.grp = p.grp AND t.block = p.block")
        most = self.con.execute("SELECT coalesce(max(no) + 1, 0) FROM outer_steps").fetchall()[0][0]
        for k in range(most):  # a level at a time, all blocks together
            self.con.execute(f"CREATE OR REPLACE TEMP TABLE folds AS SELECT id, digest, f.grp, f.block, top, proof, CASE WHEN s.s IS NULL OR f IS NULL THEN f ELSE sha256(s.s.left || f || s.s.right) END AS f FROM folds f LEFT JOIN outer_steps s ON s.grp = f.grp AND s.block = f.block AND s.no = {k}")
        return self._got("SELECT id, digest, top, proof, f FROM folds")


def _through(nodes: DataFrame, give: str, columns: dict[str, str], depth: int) -> DataFrame:
    """Deal nodes by block and hand whole blocks to DuckDB, many small ones or few large ones at a time."""
    names = list(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine, held, size = None, [], 0

        def out(t: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal engine
            engine = engine or _Engine(depth)
            engine.load(t)
            yield from getattr(engine, give)().select(names).to_batches(max_chunksize=4096)

        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            size += b.num_rows
            if size < _ROWS:
                continue
            t = pa.Table.from_batches(held)
            # rows are sorted by group and block: the last block may go on
            grp, block = t.column("grp").to_numpy(), t.column("block").to_numpy()
            whole = int(((grp != grp[-1]) | (block != block[-1])).sum())
            if whole:
                yield from out(t.slice(0, whole).combine_chunks())
            held = t.slice(whole).to_batches()
            size = t.num_rows - whole
        if held:
            yield from out(pa.Table.from_batches(held).combine_chunks())

    return nodes.repartition("grp", "block").sortWithinPartitions("grp", "block").mapInArrow(run, ", ".join(f"{c} {t}" for c, t in columns.items()))


def _given(nodes: DataFrame, depth: int, outer: DataFrame | None = None) -> DataFrame:
    """The rows that go through the engine: nodes (grp, n, place, digest and for leaves other and id), and one row a block with its own proof."""
    has = set(nodes.columns)
    kinds = _GIVEN | {"id": dict(nodes.dtypes).get("id", "bigint")}
    null = lambda c: F.lit(None).cast(kinds[c]).alias(c)
    fixed = {"block": F.floor(F.col("place") / FAN**depth).cast("long").alias("block"), "kind": F.lit(0).alias("kind")}
    rows = nodes.select(*[fixed[c] if c in fixed else F.col(c).cast(t).alias(c) if c in has else null(c) for c, t in kinds.items()])
    if outer is None:
        return rows
    mine = {"grp": F.col("grp"), "block": F.col("place").alias("block"), "kind": F.lit(1).alias("kind"), "steps": F.col("steps"), "top": F.col("top")}
    return rows.unionByName(outer.select(*[mine[c] if c in mine else null(c) for c in kinds]))


def climb(nodes: DataFrame, most: int, depth: int) -> list[DataFrame]:
    """Tables of nodes (grp, n, place, digest) from the given one up to that of one node a group, stored; ``most``: nodes of the largest group."""
    rounds = [nodes]
    while True:
        rounds.append(stored(_through(_given(rounds[-1], depth), "roots", _ROOTS, depth), "nodes"))
        if most <= FAN**depth:
            return rounds
        most = -(-most // FAN**depth)


def descend(rounds: list[DataFrame], outer: DataFrame, depth: int) -> DataFrame:
    """The proofs of the blocks of the lowest table: grp, place, steps and top; ``outer`` has those of each group's root, as place 0."""
    for nodes in rounds[-2:0:-1]:
        below = stored(_through(_given(nodes, depth, outer), "steps", _PROOFS, depth), "proofs")
        discard(outer)
        outer = below
    return outer


def manifest(rows: DataFrame, id_col: str, group_col: str, leaf_col: Column, other: Column | None = None, depth: int = DEPTH) -> DataFrame:
    """Per row: doc_id, leaf, subroot (of its group's tree), root (of the tree over subroots), proof_sha256 and folded_root.

    ``leaf_col`` makes the leaf; rows of a group are ordered by id, null first, equal ids by leaf. Groups are ordered by their name as
    UTF-8 bytes, null first, a group of its own. ``proof_sha256`` is that of the siblings from the leaf's level to the root, left to
    right, joined. ``folded_root`` is what the proof makes of ``other`` (another leaf in this one's place; the leaf itself where that is null or
    not given): equal to the root exactly if the leaf is. A group of one row has its leaf as subroot, one group its subroot as root; repeated rows are
    leaves of their own, and an empty table gives no rows. Other columns play no part. A block has ``depth`` levels.
    """
    ids = dict(rows.dtypes)[id_col]
    own = rows.select(F.col(id_col).alias("id"), F.col(group_col).alias("key"), leaf_col.alias("digest"), (leaf_col if other is None else F.coalesce(other, leaf_col)).alias("other"))
    leaves = dealt(own, [F.asc_nulls_first("key"), F.asc_nulls_first("id"), F.asc("digest")])
    nodes = stored(placed(leaves, "key").drop("key"), "placed")
    discard(leaves)
    largest = nodes.agg(F.max("n"), F.max("grp")).first()
    inner = climb(nodes, largest[0] or 0, depth)
    groups = (largest[1] or 0) + 1
    tops = inner[-1].select(F.lit(0).cast("long").alias("grp"), F.lit(groups).cast("long").alias("n"), F.col("grp").alias("place"), "digest")
    over = climb(tops, groups, depth)
    root = over[-1].select("digest").first()  # one row: the root of all
    start = over[-1].select("grp", "place", F.array().cast(_STEPS).alias("steps"), F.lit("").alias("top"))
    each = _through(_given(tops, depth, descend(over, start, depth)), "steps", _PROOFS, depth)
    roots = stored(each.select(F.col("place").alias("grp"), "steps").join(inner[-1].select("grp", F.col("digest").alias("top")), "grp").select("grp", F.lit(0).cast("long").alias("place"), "steps", "top"), "roots")
    blocks = descend(inner, roots, depth)
    done = _through(_given(nodes, depth, blocks), "proofs", {"id": ids, "digest": "string", "top": "string", "proof": "string", "f": "string"}, depth)
    return done.select(F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), F.col("top").alias("subroot"), F.lit(root[0] if root else None).alias("root"), F.col("proof").alias("proof_sha256"), F.col("f").alias("folded_root"))
