"""``raw_marks``: the raw 16-column mark layout derived from ``lineitem``.

The derivation is the portable fixture view of FIXTURES.md §3 written with
the DataFrame API: every lineitem row becomes one performance mark, with
aliases, blanks, four date layouts, codes (DNF / NM), feet-inches and wind
texts. Work grows linearly with ``lineitem``; it is a narrow projection, no
shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import compiled_plans

# Fixed value: month abbreviations used by the two text date layouts.
MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"

# Columns of ``raw_marks``; the first four are the row's source position (total tie order).
ORDINAL_COLS = ["ord_key", "line_no", "part_key", "supp_key"]
# Decimal widths of those keys (order, line, part and supplier keys of the lineitem source; 38 in
# all) so the position packs into one DECIMAL(38,0).
ORDINAL_DIGITS = {"ord_key": 15, "line_no": 2, "part_key": 11, "supp_key": 10}


def _s(c: Column) -> Column:
    return c.cast("string")


def _pad2(c: Column) -> Column:
    return F.lpad(_s(c), 2, "0")


def raw_marks_from_lineitem(lineitem: DataFrame) -> DataFrame:
    l = spread(lineitem, "l_orderkey", "l_linenumber")
    ok, ln = F.col("l_orderkey").cast("long"), F.col("l_linenumber").cast("int")
    pk, sk = F.col("l_partkey").cast("long"), F.col("l_suppkey").cast("long")
    d = F.to_date("l_shipdate")  # read by four columns of one projection, which evaluates it once
    e = l.select(ok.alias("ok"), ln.alias("ln"), pk.alias("pk"), sk.alias("sk"), F.col("l_quantity").cast("long").alias("qty"),
                 ((pk * 7919 + ok * 104729 + ln * 31) % 1000).alias("h"), (F.year(d) + 24).cast("int").alias("y"),
                 F.month(d).alias("m"), F.dayofmonth(d).alias("dd"), (pk % 16).alias("ev"),
                 F.when(sk % 2 == 0, "Men").otherwise("Women").alias("g"), F.when(F.month(d) <= 3, "Indoors").otherwise("Outdoors").alias("lab"))
    ev, h, lab, g, qty = F.col("ev"), F.col("h"), F.col("lab"), F.col("g"), F.col("qty")

    event = (
        F.when(ev < 9, F.when(lab == "Indoors",
                              F.when(h % 5 == 0, "60m").otherwise("60 Meters")).otherwise("100 Meters"))
        .when(ev == 9, F.when(lab == "Indoors", "60 Hurdles")
              .when(g == "Men", "110h").otherwise("100 Hurdles"))
        .when(ev == 10, F.when(lab == "Indoors", "Mile").otherwise("1500 Meters"))
        .when(ev == 11, "300 Meters").when(ev == 12, "10,000 Meters")
        .when(ev == 13, "High Jump").when(ev == 14, "Triple Jump").otherwise("Shot Put")
    )
    mark = (
        F.when(h % 97 == 0, "DNF").when(h % 89 == 0, "NM").when(h % 83 == 0, "")
        .when(ev < 9, F.concat(F.when(lab == "Indoors", "7.").otherwise("11."), _pad2(h % 100)))
        .when(ev == 9, F.concat(F.lit("14."), _pad2(h % 100)))
        .when(ev == 10, F.concat(F.lit("4:"), _pad2(h % 60), F.lit("."), _pad2(qty)))
        .when(ev == 11, F.concat(_s(34 + h % 9), F.lit("."), _pad2(qty)))
        .when(ev == 12, F.concat(_s(31 + h % 5), F.lit(":"), _pad2(h % 60), F.lit(".5")))
        .when(ev == 13, F.concat(_s(5 + h % 2), F.lit("-"), _pad2(h % 12), F.lit(".25")))
        .when(ev == 14, F.concat(F.lit("13."), _pad2(h % 100), F.lit("m")))
        .otherwise(F.concat(F.lit("15."), _pad2(h % 100), F.lit("M")))
    )
    wind = (
        F.when(h % 6 == 0, F.concat(F.lit("+"), _s(h % 3), F.lit("."), _s(h % 10)))
        .when(h % 6 == 1, F.concat(F.lit("-0."), _s(h % 10)))
        .when(h % 6 == 2, F.concat(F.lit("1."), _s(h % 10), F.lit("m/s")))
        .when(h % 6 == 3, "NWI").otherwise("")
    )
    mon = F.lit(MONTHS).substr(F.col("m") * 3 - 2, F.lit(3))
    ys, ms, ds = _s(F.col("y")), _pad2(F.col("m")), _pad2(F.col("dd"))
    meet_date = (
        F.when(h % 101 == 0, "TBD")
        .when(h % 4 == 0, F.concat(ys, F.lit("-"), ms, F.lit("-"), ds))
        .when(h % 4 == 1, F.concat(ms, F.lit("/"), ds, F.lit("/"), ys))
        .when(h % 4 == 2, F.concat(mon, F.lit(" "), _s(F.col("dd")), F.lit(", "), ys))
        .otherwise(F.concat(mon, F.lit(" "), _s(F.col("dd")), F.lit(" "), ys))
    )
    sk = F.col("sk")
    return e.select(
        F.col("ok").alias("ord_key"), F.col("ln").alias("line_no"),
        F.col("pk").alias("part_key"), sk.alias("supp_key"),
        F.concat(F.lit("School "), _s(sk % 7)).alias("School"),
        F.when(sk % 3 == 0, "NCAA Division I").when(sk % 3 == 1, "NCAA Division II")
         .otherwise("NCAA Division III").alias("Division"),
        g.alias("Gender"), lab.alias("SeasonLabel"), F.col("y").alias("SeasonYear"),
        event.alias("Event"),
        F.concat(F.when(h % 2 == 0, "Athlete ").otherwise(" athlete "), _s(sk)).alias("Athlete"),
        mark.alias("MarkOrTime"), wind.alias("Wind"),
        F.concat(F.lit("Meet "), _s(F.col("ok") % 50)).alias("Meet"),
        meet_date.alias("MeetDate"),
    )


#: Session setting: repartition narrow scans of the source table to so many tasks. Unset, scans stay as they are.
#: A benchmark over a file of one row group sets it; a table of many splits has no use for it.
SCAN_TASKS = "spark.peakcast.scanTasks"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    n = df.sparkSession.conf.get(SCAN_TASKS, None)
    return df.repartition(int(n), *keys) if n else df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return compiled_plans(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_marks_from_lineitem(read_table(spark, sf_dir, "lineitem"))
