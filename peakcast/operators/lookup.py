"""Event lookup for submitted requests: by 1-based list position, exact name, or unique substring.

The event side is a model's event vocabulary (one row per trained event and gender). Requests are reduced to distinct
texts first. Positions and names are equality joins. Substrings go through an inverted index: a name is listed under
each of its grams of up to three characters; a request looks only under that of its own grams that the fewest names
have, and the names found there are checked against the whole request.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import pystrip


def _grams(text: Column, sizes: tuple) -> Column:
    """Distinct substrings of the given lengths (of length 0: one empty string); a text shorter than a length has none."""
    def of(n: int | Column) -> Column:
        size = F.lit(n) if isinstance(n, int) else n
        starts = F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1)))
        return F.when(F.length(text) >= size, F.transform(starts, lambda i: F.substring(text, i, size)))

    parts = [of(n) for n in sizes]
    return F.array_distinct(F.flatten(F.filter(F.array(*parts), lambda p: p.isNotNull())))


def resolve_events(requests: DataFrame, events: DataFrame) -> DataFrame:
    """requests(gender, text) x events(Gender, event, event_id) -> (gender, text, event, status).

    status: ok / ambiguous (several substring matches) / not_found.
    """
    req = requests.select("gender", "text").distinct().withColumn("_raw", pystrip(F.col("text")))
    ev = events.select(F.col("Gender").alias("gender"), F.col("event").alias("_e"), F.col("event_id").alias("_id"))
    whole = F.col("_raw").rlike("^[0-9]+$")
    at = (req.select("gender", "text", F.when(whole, F.col("_raw").try_cast("long") - 1).alias("_id")).join(ev, ["gender", "_id"])
          .groupBy("gender", "text").agg(F.min("_e").alias("_pos")))
    name = (req.join(ev.select("gender", "_e", F.col("_e").alias("_raw")), ["gender", "_raw"])
            .groupBy("gender", "text").agg(F.min("_e").alias("_name")))
    index = ev.select("gender", "_e", F.explode(_grams(F.lower("_e"), (0, 1, 2, 3))).alias("_gram"))
    # The empty gram stands for all names of a gender, of which an empty request needs the number and the least only.
    listed = index.groupBy("gender", "_gram").agg(F.count(F.lit(1)).alias("_names"), F.min("_e").alias("_least"))
    own = req.select("gender", "text", F.lower("_raw").alias("_low"))
    size = F.least(F.length("_low"), F.lit(3))
    asked = own.select("*", F.explode(_grams(F.col("_low"), (size,))).alias("_gram")).join(listed, ["gender", "_gram"], "left")
    rarest = (asked.groupBy("gender", "text", "_low")
              .agg(F.min(F.struct(F.coalesce("_names", F.lit(0)).alias("_names"), F.col("_gram"), F.col("_least"))).alias("_r"))
              .select("gender", "text", "_low", "_r.*"))
    hits = (rarest.filter((F.col("_low") != "") & (F.col("_names") > 0)).join(index, ["gender", "_gram"])
            .filter(F.lower("_e").contains(F.col("_low"))).groupBy("gender", "text")
            .agg(F.count(F.lit(1)).alias("_n"), F.min("_e").alias("_sub")))
    empty = rarest.filter("_low = '' AND _names > 0").select("gender", "text", F.col("_names").alias("_n"), F.col("_least").alias("_sub"))
    out = req.select("gender", "text")
    for found in (at, name, hits.unionByName(empty)):
        out = out.join(found, ["gender", "text"], "left")
    event = F.coalesce(F.col("_pos"), F.col("_name"), F.when(F.col("_n") == 1, F.col("_sub")))
    status = F.when(event.isNotNull(), "ok").when(F.col("_n") > 1, "ambiguous").otherwise("not_found")
    return out.select("gender", "text", event.alias("event"), status.alias("status"))
