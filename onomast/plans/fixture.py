"""Collector strings made from the benchmark tables, by arithmetic that any SQL engine does alike.

The tables hold no names of people. A line item gives a record: two words of its part's name make the first person, those
of the part numbered like its supplier the second; the shape of the string follows from the keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SHAPES = """
    SELECT record_id, kingdom, arrival, seen_at, CASE k
        WHEN 0 THEN concat(s, ', ', gi, '.')
        WHEN 1 THEN concat(s, ', ', gi, '.', hi, '.')
        WHEN 2 THEN concat(gi, '. ', s)
        WHEN 3 THEN concat(g, ' ', s)
        WHEN 4 THEN concat(s, ', ', gi, '. & ', t, ', ', hi, '.')
        WHEN 5 THEN concat(s, ', ', gi, '.; ', t, ', ', hi, '.')
        WHEN 6 THEN concat(gi, '. ', s, ' 410, ', hi, '. ', t, ' 44')
        WHEN 7 THEN concat(gi, '. ', s, ' (67)')
        WHEN 8 THEN upper(s)
        WHEN 9 THEN CASE WHEN arrival % 3 = 0 THEN '?' WHEN arrival % 3 = 1 THEN 'sem coletor' ELSE '' END
        WHEN 10 THEN concat('Equipe de ', s)
        WHEN 12 THEN concat(s, ', ', gi, '. et al.')
        WHEN 13 THEN concat(gi, '. ', s, ' | ', hi, '. ', t)
        WHEN 14 THEN concat(s, ', ', gi, '., ', t, ', ', hi, '.')
        WHEN 15 THEN concat(gi, '. ', s, ' e ', hi, '. ', t)
        WHEN 16 THEN concat(gi, '. ', s, ' and ', hi, '. ', t)
        WHEN 17 THEN concat(g, '7 ', s)
        ELSE s END AS text
    FROM (
        SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS record_id, CASE WHEN (l_orderkey + l_linenumber) % 17 = 0 THEN 'Fungi' ELSE 'Plantae' END AS kingdom,
            l_orderkey * 8 + l_linenumber AS arrival, (l_orderkey * 5 + l_linenumber + l_partkey) % 18 AS k, l_shipdate AS seen_at,
            concat(upper(substr(split_part(p.p_name, ' ', 1), 1, 1)), substr(split_part(p.p_name, ' ', 1), 2)) AS g, upper(substr(split_part(p.p_name, ' ', 1), 1, 1)) AS gi,
            concat(upper(substr(split_part(p.p_name, ' ', 2), 1, 1)), substr(split_part(p.p_name, ' ', 2), 2)) AS s,
            upper(substr(split_part(q.p_name, ' ', 1), 1, 1)) AS hi, concat(upper(substr(split_part(q.p_name, ' ', 2), 1, 1)), substr(split_part(q.p_name, ' ', 2), 2)) AS t
        FROM {lineitem} l JOIN {part} p ON p.p_partkey = l.l_partkey JOIN {part} q ON q.p_partkey = l.l_suppkey
    ) shaped
"""

_RECORDS = """
    SELECT record_id, kingdom, CASE WHEN arrival % 13 = 0 THEN '' ELSE text END AS collector, CASE WHEN arrival % 13 = 0 THEN text ELSE NULL END AS recordedBy, arrival, seen_at FROM ({shapes}) made
"""


def records_sql(lineitem: str = "lineitem", part: str = "part") -> str:
    """The records as a query over the given tables."""
    return _RECORDS.format(shapes=_SHAPES.replace("{lineitem}", lineitem).replace("{part}", part))


_INITIAL = "upper(substr(split_part({0}.p_name, ' ', 1), 1, 1))"
_CASED = "concat(upper(substr(split_part({0}.p_name, ' ', {1}), 1, 1)), substr(split_part({0}.p_name, ' ', {1}), 2))"


def _words(part: DataFrame) -> DataFrame:
    """p_partkey and the words that records are made of, worked out once a part and not once a line item."""
    made = part.alias("p").select(F.struct("p_partkey", F.expr(_CASED.format("p", 1)).alias("g"), F.expr(_INITIAL.format("p")).alias("i"), F.expr(_CASED.format("p", 2)).alias("s")).alias("w"))
    return made.select(F.explode_outer(F.array("w")).alias("w")).select("w.*")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """record_id, kingdom, collector, recordedBy, arrival and seen_at.

    The rows pass through an outer explosion of one element: real records are plain columns of a file, and filters on these
    must not be rewritten into the long expressions that make them up here. So do the words of parts.
    """
    sql = records_sql("{lineitem}", "{part}")
    for own in ("p", "q"):
        sql = sql.replace(_CASED.format(own, 1), f"{own}.g").replace(_CASED.format(own, 2), f"{own}.s").replace(_INITIAL.format(own), f"{own}.i")
    made = spark.sql(sql, lineitem=spark.read.parquet(f"{sf_dir}/lineitem.parquet"), part=_words(spark.read.parquet(f"{sf_dir}/part.parquet")))
    return made.select(F.explode_outer(F.array(F.struct("*"))).alias("r")).select("r.*")
