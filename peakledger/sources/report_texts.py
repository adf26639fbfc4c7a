"""Report files written out of the given tables, good and damaged, for the parsers.

Each file holds one day or one hour of one series, so a text has at most 24 lines or 12 blocks however large the tables are.
Every file of this module has the columns report, name, text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from peakledger.functions import clock, names
from peakledger.sources.feeds import listed_files, table

MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()


def _sums(spark: SparkSession, sf_dir: str, *by: Column) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(*by).agg(F.sum(F.col("value").cast("decimal(18,2)")).alias("mw"))


def _day() -> Column:
    return F.col("ts").cast("date").alias("day")


def _digits(day: Column) -> Column:
    return F.replace(day.cast("string"), F.lit("-"), F.lit(""))


def _in_order(by: str) -> Column:
    """The group's (position, mw), by position."""
    return F.array_sort(F.collect_list(F.struct(F.col(by).cast("int").alias("at"), F.col("mw"))))


def _joined(parts: Column, glue: str = "") -> Column:
    return F.array_join(parts, glue)


def hourly_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day of one event type. The header is wrong on days 5, 10, ... of a month; days 1, 6, ... end in an unreadable row."""
    days = (_sums(spark, sf_dir, F.col("event_type"), _day(), F.hour("ts").alias("hour"))
            .groupBy("event_type", "day").agg(_in_order("hour").alias("hours")))
    rows = F.transform("hours", lambda x: F.concat_ws(",", F.col("day").cast("string"), (x["at"] + 1).cast("string"), x["mw"].cast("string")))
    damage = F.dayofmonth("day") % 5
    header = F.when(damage == 0, "Date;Hour").otherwise("Date,Hour,Ontario Demand")
    last = F.when(damage == 1, "\nno row").otherwise("")
    return days.select(F.lit("ICIDemand").alias("report"), F.concat(F.lit("PUB_ICIDemand_"), "event_type", F.lit("_"), _digits(F.col("day")), F.lit("_v1.csv")).alias("name"),
                       F.concat(F.lit("\\\\one\n\\\\two\n\\\\three\n"), header, F.lit("\n"), _joined(rows, "\n"), last, F.lit("\n")).alias("text"))


def _quantity(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"<MQ><MarketQuantity>{name}</MarketQuantity><EnergyMW>"), value.cast("string"), F.lit("</EnergyMW></MQ>"))


def five_minute_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An hour of all event types. On days 4, 8, ... intervals keep the numbers of their slots, gaps included; in hours 1, 7, ... the
    first block has no demand; in hours 2, 8, ... the text breaks off."""
    slot = F.floor(F.minute("ts") / 5).alias("slot")
    hours = _sums(spark, sf_dir, _day(), F.hour("ts").alias("hour"), slot).groupBy("day", "hour").agg(_in_order("slot").alias("slots"))
    natural = F.dayofmonth("day") % 4 == 0

    def block(x, i):
        demand = F.when((F.col("hour") % 6 == 1) & (i == 0), "").otherwise(_quantity("ONTARIO DEMAND", x["mw"]))
        number = F.when(natural, x["at"] + 1).otherwise(i + 1)
        return F.concat(F.lit("<IntervalEnergy><Interval>"), number.cast("string"), F.lit("</Interval>"),
                        _quantity("Total Load", x["mw"] + F.lit(1000)), demand, F.lit("</IntervalEnergy>"))

    end = F.when(F.col("hour") % 6 == 2, "</Energies>").otherwise("</Energies></DocBody></Document>")
    text = F.concat(F.lit("<Document><DocBody><DeliveryDate>"), F.col("day").cast("string"), F.lit("</DeliveryDate><DeliveryHour>"),
                    (F.col("hour") + 1).cast("string"), F.lit("</DeliveryHour><Energies>"), _joined(F.transform("slots", block)), end)
    name = F.concat(F.lit("PUB_RealtimeTotals_"), _digits(F.col("day")), F.lpad((F.col("hour") + 1).cast("string"), 2, "0"), F.lit("_v1.xml"))
    return hours.select(F.lit("RealtimeTotals").alias("report"), name.alias("name"), text.alias("text"))


def forecast_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day of all event types, once as CSV and once as XML. Days 5, 10, ... lack hour 7; days 1, 6, ... lack the load: in the CSV its
    column, in the XML one quantity."""
    hours = _sums(spark, sf_dir, _day(), F.hour("ts").alias("hour"))
    days = (hours.where(~((F.dayofmonth("day") % 5 == 0) & (F.col("hour") == 6)))
            .groupBy("day").agg(_in_order("hour").alias("hours")))
    lacking = F.dayofmonth("day") % 5 == 1
    lines = F.transform("hours", lambda x: F.concat_ws(",", (x["at"] + 1).cast("string"), F.lit("0,5"), x["mw"].cast("string")))
    head = F.concat(F.lit("one\r\ntwo\r\nthree\r\n\\\\MADE 2024/03/01 FOR "), F.replace(F.col("day").cast("string"), F.lit("-"), F.lit("/")), F.lit("\r\n"))
    column = F.when(lacking, "TOTAL LOSS").otherwise("TOTAL LOAD")
    csv = F.concat(head, F.lit("HOUR,INTERVAL,TOTAL ENERGY,"), column, F.lit("\r\n"), _joined(lines, "\r\n"), F.lit("\r\n"))

    def block(x):
        load = F.when(lacking & (x["at"] == 2), "").otherwise(_quantity("Total Load", x["mw"]))
        return F.concat(F.lit("<HourlyConstrainedEnergy><DeliveryHour>"), (x["at"] + 1).cast("string"), F.lit("</DeliveryHour>"),
                        _quantity("Total Energy", x["mw"] + F.lit(5)), load, F.lit("</HourlyConstrainedEnergy>"))

    xml = F.concat(F.lit("<Document><DocBody><DeliveryDate>"), F.col("day").cast("string"), F.lit("</DeliveryDate><Energies>"),
                   _joined(F.transform("hours", block)), F.lit("</Energies></DocBody></Document>"))
    both = F.explode(F.array(F.struct(F.lit("csv").alias("ext"), csv.alias("text")), F.struct(F.lit("xml").alias("ext"), xml.alias("text"))))
    name = F.concat(F.lit("PUB_PredispTotals_"), _digits(F.col("day")), F.lit("_v1."), F.col("f.ext"))
    return days.select("day", both.alias("f")).select(F.lit("PredispTotals").alias("report"), name.alias("name"), F.col("f.text").alias("text"))


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """report, html: index pages, one per file group, each file with its first publish time in market time, next to links that are
    no report files."""
    files = listed_files(spark, sf_dir).groupBy("report", "name").agg(F.min("published_at").alias("at"))
    at = clock.est(F.col("at"))
    month = F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(at))
    stamp = F.concat(F.lpad(F.day(at).cast("string"), 2, "0"), F.lit("-"), month, F.lit("-"), F.year(at).cast("string"), F.lit(" "),
                     F.substring(at.cast("string"), 12, 5))
    line = F.concat(F.lit('<img src="i"> <a href="'), "name", F.lit('">'), "name", F.lit("</a>  "), stamp, F.lit("   7K"))
    pages = files.select("report", names.group_of(F.col("name")).alias("file_group"), line.alias("line")).groupBy("report", "file_group").agg(
        F.collect_list("line").alias("lines"))
    return pages.select("report", F.concat(F.lit('<pre><a href="?C=N">Name</a> <a href="/up/">Up</a>   -\n'), _joined(F.col("lines"), "\n"), F.lit("\n</pre>")).alias("html"))
