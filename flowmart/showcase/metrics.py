"""Flow metrics over the flow view."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowmart.operators import metrics as m
from flowmart.showcase.registry import query
from flowmart.showcase.views import CLASS_FLOWS, FLOWS, class_flows, exact_sum, flows, table

HOME, PEERS, PATENTS = ["NATION_3"], ["NATION_5", "NATION_11"], ["PA1a", "PA1b"]
PLAIN = m.Fields()


@query("bilateral_volume", f"""WITH {FLOWS}
SELECT year, indicator, SUM("count") AS volume FROM flows
WHERE origin IN ('NATION_3') AND destination_office IN ('NATION_5','NATION_11')
  AND indicator IN ('PA1a','PA1b') AND year IN (1996, 2000) GROUP BY year, indicator""")
def bilateral_volume(spark, sf):
    return m.volume(m.flow_filter(flows(spark, sf), HOME, PEERS, PATENTS, [1996, 2000]))


@query("empty_selection", f"""WITH {FLOWS}
SELECT 'no destination' AS selection, 0.0::DOUBLE AS total
UNION ALL SELECT 'any destination', COALESCE(SUM("count"), 0.0) FROM flows WHERE origin='NATION_3' AND indicator IN ('PA1a','PA1b')""")
def empty_selection(spark, sf):
    """An empty list selects nothing and gives zero, no list selects all."""
    def of(name, dests):
        return m.total(m.flow_filter(flows(spark, sf), HOME, dests, PATENTS)).select(F.lit(name).alias("selection"), "total")
    return of("no destination", []).unionByName(of("any destination", None))


@query("total_volume", f"""WITH {FLOWS}
SELECT COALESCE(SUM("count"), 0.0) AS total FROM flows
WHERE origin='NATION_3' AND indicator IN ('PA1a','PA1b') AND year=2000""")
def total_volume(spark, sf):
    return m.total(m.flow_filter(flows(spark, sf), HOME, None, PATENTS, [2000]))


@query("share_of_total", f"""WITH {FLOWS}, s AS (
SELECT year, COALESCE(SUM(CASE WHEN destination_office IN ('NATION_5','NATION_11') THEN "count" END), 0) AS volume,
  SUM("count") AS total FROM flows WHERE origin='NATION_3' AND indicator IN ('PA1a','PA1b') GROUP BY year)
SELECT year, volume, total, CASE WHEN total=0 THEN 0 ELSE volume/total*100.0 END AS share FROM s""")
def share_of_total(spark, sf):
    return m.share_of_total(flows(spark, sf), HOME, PEERS, PATENTS)


@query("share_without_members", f"""WITH {FLOWS}, s AS (
SELECT year, COALESCE(SUM(CASE WHEN destination_office IN ('NATION_5','NATION_11') THEN "count" END), 0) AS volume,
  SUM("count") AS total FROM flows WHERE origin='NATION_3' AND destination_office <> 'NATION_0' GROUP BY year)
SELECT year, volume, total, CASE WHEN total=0 THEN 0 ELSE volume/total*100.0 END AS share FROM s""")
def share_without_members(spark, sf):
    return m.share_of_total(flows(spark, sf), HOME, PEERS, exclude_members=["NATION_0"])


@query("pct_change", f"""WITH {FLOWS}, s AS (
SELECT origin, COALESCE(SUM(CASE WHEN year=1996 THEN "count" END), 0) AS volume_from,
  COALESCE(SUM(CASE WHEN year=2000 THEN "count" END), 0) AS volume_to
FROM flows WHERE indicator IN ('TM1a','TM1b') AND year IN (1996, 2000) GROUP BY origin)
SELECT origin, volume_from, volume_to, (volume_to-volume_from)/NULLIF(volume_from,0)*100.0 AS pct_change FROM s""")
def pct_change(spark, sf):
    return m.pct_change(m.flow_filter(flows(spark, sf), indicators=["TM1a", "TM1b"]), 1996, 2000, ["origin"])


@query("rank_of_group", f"""WITH {FLOWS}, each AS (
SELECT year, destination_office, SUM("count") AS vol FROM flows
WHERE origin='NATION_3' AND indicator IN ('PA1a','PA1b') GROUP BY year, destination_office),
grp AS (SELECT year, COALESCE(SUM(CASE WHEN destination_office IN ('NATION_5','NATION_11') THEN vol END), 0) AS group_volume
  FROM each GROUP BY year)
SELECT year, group_volume, CAST(1 + COUNT(*) FILTER (WHERE vol > group_volume) AS BIGINT) AS group_rank
FROM each JOIN grp USING (year) GROUP BY year, group_volume""")
def rank_of_group(spark, sf):
    return m.rank_of_group(flows(spark, sf), HOME, PEERS, PATENTS)


@query("year_spine", f"""WITH {FLOWS}, s AS (SELECT year, SUM("count") AS volume FROM flows
WHERE origin='NATION_3' AND destination_office IN ('NATION_5','NATION_11') AND indicator IN ('PA1a','PA1b')
  AND year BETWEEN 1993 AND 2003 GROUP BY year)
SELECT CAST(y AS INT) AS year, COALESCE(volume, 0.0) AS volume FROM range(1993, 2004) r(y) LEFT JOIN s ON s.year=y""")
def year_spine(spark, sf):
    return m.timeseries(flows(spark, sf), HOME, PEERS, PATENTS, 1993, 2003)


@query("year_spine_by_member", f"""WITH {FLOWS}, s AS (SELECT destination_office, year, SUM("count") AS volume FROM flows
WHERE origin='NATION_3' AND indicator='PA1a' GROUP BY destination_office, year)
SELECT k.destination_office, CAST(y AS INT) AS year, COALESCE(volume, 0.0) AS volume
FROM (SELECT DISTINCT destination_office FROM s) k CROSS JOIN range(1993, 2004) r(y)
LEFT JOIN s ON s.year=y AND s.destination_office=k.destination_office""")
def year_spine_by_member(spark, sf):
    volumes = m.volume(m.flow_filter(flows(spark, sf), HOME, None, ["PA1a"]), ["destination_office", "year"])
    return m.fill_years(volumes, 1993, 2003, ["volume"], ["destination_office"])


def _way(right: str, a: str, b: str, origin: str, dest: str) -> str:
    test = f"origin IN {origin} AND destination_office IN {dest} AND indicator IN ('{right}1a','{right}1b')"
    return f'COALESCE(SUM(CASE WHEN {test} THEN "count" END), 0) AS "{right} From {a} to {b}"'


_A, _B = "('NATION_3')", "('NATION_5','NATION_11')"
_WAYS = [_way(r, "A", "B", _A, _B) for r in ("PA", "TM", "ID")] + [_way(r, "B", "A", _B, _A) for r in ("PA", "TM", "ID")]
_NAMES = [f"{r} From {a} to {b}" for a, b in (("A", "B"), ("B", "A")) for r in ("PA", "TM", "ID")]


@query("bilateral_table", f"""WITH {FLOWS}, s AS (SELECT year, {', '.join(_WAYS)} FROM flows GROUP BY year)
SELECT CAST(y AS INT) AS year, {', '.join(f'CAST(round_even(COALESCE("{n}", 0), 0) AS BIGINT) AS "{n}"' for n in _NAMES)}
FROM range(1993, 2004) r(y) LEFT JOIN s ON s.year=y""")
def bilateral_table(spark, sf):
    return m.bilateral_table(flows(spark, sf), HOME, PEERS, 1993, 2003)


def _share(right: str) -> str:
    codes = f"('{right}1a','{right}1b')"
    return (
        f"COALESCE(SUM(CASE WHEN origin='NATION_3' AND indicator IN {codes} THEN \"count\" END) / "
        f"NULLIF(SUM(CASE WHEN indicator IN {codes} THEN \"count\" END), 0) * 100.0, 0.0) AS pct_global_{right}_from_origin_total"
    )


@query("global_share", f"""WITH {FLOWS}, s AS (SELECT year, {', '.join(_share(r) for r in ('PA', 'TM', 'ID'))}
FROM flows GROUP BY year)
SELECT CAST(y AS INT) AS year, {', '.join(f'COALESCE(pct_global_{r}_from_origin_total, 0.0) AS pct_global_{r}_from_origin_total' for r in ('PA', 'TM', 'ID'))}
FROM range(1993, 2004) r(y) LEFT JOIN s ON s.year=y""")
def global_share(spark, sf):
    return m.global_share(flows(spark, sf), HOME, 1993, 2003)


@query("top_classes", f"""WITH {CLASS_FLOWS}, v AS (SELECT class_code, SUM("count") AS vol FROM class_flows
WHERE origin='NATION_3' AND year=1998 GROUP BY class_code)
SELECT class_code, vol, round_even(vol / (SELECT SUM(vol) FROM v) * 100.0, 2) AS pct_share FROM v
ORDER BY vol DESC, class_code LIMIT 3""")
def top_classes(spark, sf):
    return m.top_classes(class_flows(spark, sf), HOME, None, 1998, n=3, fields=PLAIN)


@query("share_within_year", f"""WITH {CLASS_FLOWS}, v AS (SELECT year, class_code, SUM("count") AS vol FROM class_flows GROUP BY ALL)
SELECT year, class_code, vol, vol / SUM(vol) OVER (PARTITION BY year) * 100.0 AS pct_share FROM v""")
def share_within_year(spark, sf):
    return m.with_share(m.volume(class_flows(spark, sf), ["year", "class_code"], out="vol"), "vol", ["year"], store=True)


@query("share_of_each_total", f"""WITH {CLASS_FLOWS}, v AS (SELECT year, class_code, SUM("count") AS vol FROM class_flows GROUP BY ALL)
SELECT year, class_code, vol, vol / SUM(vol) OVER (PARTITION BY year) * 100.0 AS pct_of_year,
  vol / SUM(vol) OVER (PARTITION BY class_code) * 100.0 AS pct_of_class, vol / SUM(vol) OVER () * 100.0 AS pct_of_all FROM v""")
def share_of_each_total(spark, sf):
    """Shares of the year, of the class and of everything, from one aggregate."""
    shares = {"pct_of_year": ["year"], "pct_of_class": ["class_code"], "pct_of_all": []}
    return m.with_shares(m.volume(class_flows(spark, sf), ["year", "class_code"], out="vol"), "vol", shares, store=True)


_RANKED = """CAST(RANK() OVER (PARTITION BY year ORDER BY volume DESC) AS BIGINT) AS rank,
  CAST(ROW_NUMBER() OVER (PARTITION BY year ORDER BY volume DESC, {e}) AS BIGINT) AS position"""
_BY_DEST = 'v AS (SELECT year, destination_office, SUM("count") AS volume FROM flows GROUP BY ALL)'


def _dest_volumes(spark, sf):
    return m.volume(flows(spark, sf), ["year", "destination_office"])


@query("rank_by_year", f"""WITH {FLOWS}, {_BY_DEST}
SELECT year, destination_office, volume, {_RANKED.format(e='destination_office')} FROM v WHERE destination_office <> 'NATION_0'""")
def rank_by_year(spark, sf):
    return m.rank_by_year(_dest_volumes(spark, sf), "destination_office", "volume", exclude_members=["NATION_0"])


@query("rank_parts_by_year", f"""WITH v AS (SELECT CAST(year(l_shipdate) AS INT) AS year, l_partkey,
  CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS volume FROM lineitem GROUP BY ALL)
SELECT year, l_partkey, volume, {_RANKED.format(e='l_partkey')} FROM v""")
def rank_parts_by_year(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("year"), "l_partkey")
    return m.rank_by_year(lines.agg(exact_sum("l_quantity").alias("volume")), "l_partkey", "volume")


@query("min_points", """WITH v AS (SELECT CAST(year(o_orderdate) AS INT) AS year, o_custkey, COUNT(*) AS n FROM orders GROUP BY ALL)
SELECT year, o_custkey, n, CAST(COUNT(*) OVER (PARTITION BY o_custkey) AS BIGINT) AS years FROM v
QUALIFY COUNT(*) OVER (PARTITION BY o_custkey) >= 4""")
def min_points(spark, sf):
    yearly = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year"), "o_custkey").agg(F.count("*").alias("n"))
    return m.min_points(yearly, "o_custkey", 4)


@query("overlap_years", f"""WITH {FLOWS}, e AS (SELECT MIN(year) FILTER (WHERE indicator='PA1a') AS a0, MAX(year) FILTER (WHERE indicator='PA1a') AS a1,
  MIN(year) FILTER (WHERE indicator='TM1b') AS b0, MAX(year) FILTER (WHERE indicator='TM1b') AS b1 FROM flows)
SELECT GREATEST(a0, b0) AS first_year, LEAST(a1, b1) AS last_year FROM e""")
def overlap_years(spark, sf):
    return m.overlap_years(flows(spark, sf), "indicator", "PA1a", "TM1b")


_SIDES = """s AS (SELECT l_returnflag AS side, CAST(year(l_shipdate) AS INT) AS year, l_suppkey,
  CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS volume FROM lineitem
  WHERE NOT (l_returnflag='A' AND year(l_shipdate) < 1997) AND NOT (l_returnflag='N' AND year(l_shipdate) > 2000) GROUP BY ALL)"""


@query("overlap_window", f"""WITH {_SIDES}, e AS (SELECT GREATEST(MIN(year) FILTER (WHERE side='A'), MIN(year) FILTER (WHERE side='N')) AS lo,
  LEAST(MAX(year) FILTER (WHERE side='A'), MAX(year) FILTER (WHERE side='N')) AS hi FROM s)
SELECT s.* FROM s, e WHERE side IN ('A','N') AND year BETWEEN lo AND hi""")
def overlap_window(spark, sf):
    line = table(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate"))
    early = (F.col("l_returnflag") == "A") & (F.col("year") < 1997)
    late = (F.col("l_returnflag") == "N") & (F.col("year") > 2000)
    sides = line.where(~early & ~late).groupBy(F.col("l_returnflag").alias("side"), "year", "l_suppkey")
    return m.overlap_window(sides.agg(exact_sum("l_quantity").alias("volume")), "side", "A", "N")


_PINNED = """last AS (SELECT {e} AS e, position AS slot FROM r WHERE year=(SELECT MAX(year) FROM r) AND position <= 5),
first AS (SELECT {e} AS e, ROW_NUMBER() OVER (ORDER BY position DESC) AS slot FROM r
  WHERE year=(SELECT MIN(year) FROM r) AND position <= 5 AND {e} NOT IN (SELECT e FROM last))
SELECT r.*, CASE WHEN last.e IS NOT NULL THEN 'last_top' WHEN first.e IS NOT NULL THEN 'first_top' ELSE 'other' END AS cohort,
  CAST(COALESCE(last.slot, first.slot) AS BIGINT) AS slot
FROM r LEFT JOIN last ON r.{e}=last.e LEFT JOIN first ON r.{e}=first.e"""


@query("cohort_pin", f"""WITH {FLOWS}, {_BY_DEST}, r AS (SELECT year, destination_office, volume, {_RANKED.format(e='destination_office')} FROM v),
{_PINNED.format(e='destination_office')}""")
def cohort_pin(spark, sf):
    ranked = m.rank_by_year(_dest_volumes(spark, sf), "destination_office", "volume")
    return m.cohort_pin(ranked, "destination_office", 5, store=True)


@query("ranking_table", f"""WITH {FLOWS}, d AS (
  SELECT 'out' AS direction, year, destination_office AS partner, SUM("count") AS volume FROM flows WHERE origin='NATION_3' GROUP BY ALL
  UNION ALL
  SELECT 'in' AS direction, year, origin AS partner, SUM("count") AS volume FROM flows WHERE destination_office='NATION_3' GROUP BY ALL),
e AS (SELECT GREATEST(MIN(year) FILTER (WHERE direction='in'), MIN(year) FILTER (WHERE direction='out')) AS lo,
  LEAST(MAX(year) FILTER (WHERE direction='in'), MAX(year) FILTER (WHERE direction='out')) AS hi FROM d),
k AS (SELECT direction, year, partner, volume, {_RANKED.format(e='partner')} FROM d WHERE direction='out'),
r AS (SELECT k.*, CAST(COUNT(*) OVER (PARTITION BY partner) AS BIGINT) AS years FROM k, e
  WHERE year BETWEEN lo AND hi AND volume <> 0 QUALIFY COUNT(*) OVER (PARTITION BY partner) >= 2),
{_PINNED.format(e='partner')}""")
def ranking_table(spark, sf):
    fact = flows(spark, sf)
    ways = []
    for name, here, there in (("out", "origin", "destination_office"), ("in", "destination_office", "origin")):
        one = fact.where(F.col(here) == HOME[0]).groupBy(F.lit(name).alias("direction"), "year", F.col(there).alias("partner"))
        ways.append(one.agg(F.sum("count").alias("volume")))
    return m.ranking_table(
        ways[0].unionByName(ways[1]), "partner", "volume", 5, "direction", ("in", "out"), "out", drop_zero=True
    )
