"""Outputs of a micro-batch that become visible together.

A batch writes each of its outputs into a folder of its own id and then one manifest row. Readers
join the manifest, so they see all outputs of a batch or none. A batch that failed half-way has no
manifest; when it is repeated it replaces what it left. One that comes again after its manifest was
written (the stream stopped before it noted the batch) is not run a second time.
"""

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import remove, scope


class BatchOutputs:
    """A folder of outputs by batch; a class that writes them has ``out`` and ``detect``."""

    out: str
    #: Tables carried to the next batch; the last two batches of them are kept.
    carried: tuple = ()

    def detect(self, batch: DataFrame, batch_id: int) -> None:
        raise NotImplementedError

    def _read(self, spark: SparkSession, name: str, batch_id: int) -> DataFrame | None:
        return spark.read.parquet(f"{self.out}/{name}/batch_id={batch_id}") if batch_id >= 0 else None

    def _write(self, df: DataFrame, name: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.out}/{name}/batch_id={batch_id}")

    def _keep(self, df: DataFrame, name: str, batch_id: int) -> DataFrame:
        """Write an output and go on from what was written; it must not change until the batch ends."""
        self._write(df, name, batch_id)
        return df.sparkSession.read.schema(df.schema).parquet(f"{self.out}/{name}/batch_id={batch_id}")

    def committed(self, spark: SparkSession, batch_id: int) -> bool:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.out}/commits/batch_id={batch_id}/_SUCCESS")
        return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Run one micro-batch; its cuts go with it, and so does state that no batch can ask for."""
        spark = batch.sparkSession
        if self.committed(spark, batch_id):
            return
        begun = time.time()
        with scope(spark):
            self.detect(batch, batch_id)
        took = time.time() - begun
        manifest = spark.createDataFrame([(begun, took)], "started double, seconds double")
        self._write(manifest.coalesce(1), "commits", batch_id)
        for name in self.carried:
            remove(spark, f"{self.out}/{name}/batch_id={batch_id - 2}")

    def commits(self, spark: SparkSession) -> DataFrame:
        """(batch_id, started, seconds) of every batch that is complete."""
        return spark.read.schema("started double, seconds double, batch_id long").parquet(f"{self.out}/commits")

    def results(self, spark: SparkSession, name: str) -> DataFrame:
        """An output of all complete batches."""
        return spark.read.parquet(f"{self.out}/{name}").join(
            F.broadcast(self.commits(spark).select("batch_id")), "batch_id", "left_semi")  # one row per batch

    def start(self, stream: DataFrame, checkpoint: str, available_now: bool = True, every: str = "30 seconds"):
        writer = stream.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
        return writer.start()
