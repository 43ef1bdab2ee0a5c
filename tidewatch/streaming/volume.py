"""Hourly volume of a stream: windows that close behind a watermark, and the rows that come too late."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.streaming.commits import BatchOutputs

_SUMS = ("normal_packets", "anomalous_packets")


def hourly_sums(flows: DataFrame) -> DataFrame:
    """(hour_bin, normal_packets, anomalous_packets); rows without a label count as normal, without a time under null."""
    bad, packets = F.coalesce(F.col("label") == 1, F.lit(False)), F.col("packets_count")
    return flows.groupBy(F.date_trunc("hour", "timestamp").alias("hour_bin")).agg(
        F.coalesce(F.sum(F.when(~bad, packets)), F.lit(0)).alias("normal_packets"),
        F.coalesce(F.sum(F.when(bad, packets)), F.lit(0)).alias("anomalous_packets"))


def added(*parts: DataFrame) -> DataFrame:
    """Sums per hour of tables of sums."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.groupBy("hour_bin").agg(*[F.sum(c).alias(c) for c in _SUMS])


@dataclass
class HourlyVolume(BatchOutputs):
    """Closed windows leave the state for good: ``closed`` gets each once, when the watermark has passed it.

    The watermark is the newest time of the batches before, less ``delay_s``. Rows of a window that was closed go to
    ``late``. ``open`` is all that is carried on: the hours between the watermark and the newest row, whatever
    has gone before. Closed windows, open ones and late rows add up to all rows.
    """

    out: str
    delay_s: float = 600
    carried: tuple = ("open", "mark")

    def detect(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = self._read(spark, "mark", batch_id - 1)
        mark = before.first()["mark"] if before is not None else None
        newest = batch.agg(F.max(F.unix_micros(F.col("timestamp").cast("timestamp")))).first()[0]
        ends = F.unix_micros(F.date_trunc("hour", "timestamp").cast("timestamp")) + 3_600_000_000
        too_late = F.coalesce(ends <= F.lit(mark), F.lit(False)) if mark is not None else F.lit(False)
        self._write(batch.where(too_late), "late", batch_id)
        sums, past = hourly_sums(batch.where(~too_late)), self._read(spark, "open", batch_id - 1)
        if past is not None:
            sums = added(sums, past)
        if newest is not None:
            passed = newest - int(self.delay_s * 1e6)
            mark = passed if mark is None else max(mark, passed)
        ended = F.unix_micros(F.col("hour_bin").cast("timestamp")) + 3_600_000_000 <= F.lit(mark)
        ended = F.coalesce(ended, F.lit(False))
        self._write(sums.where(ended), "closed", batch_id)
        self._write(sums.where(~ended), "open", batch_id)
        self._write(spark.createDataFrame([(mark,)], "mark long").coalesce(1), "mark", batch_id)

    def totals(self, spark: SparkSession) -> DataFrame:
        """All windows, the open ones and late rows included, as a batch over all rows gives them."""
        last = self.commits(spark).agg(F.max("batch_id")).first()[0]
        closed, late = self.results(spark, "closed").drop("batch_id"), self.results(spark, "late")
        return added(closed, self._read(spark, "open", last), hourly_sums(late))
