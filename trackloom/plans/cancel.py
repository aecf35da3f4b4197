"""Jobs that can be cancelled from another thread: tagged work, streams stopped, and no partial output."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


class Cancelled(RuntimeError):
    """The job was cancelled before its output was complete."""


class Cancellation:
    """Names one job; ``cancel`` may be called from any thread, before, during or after it."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.tag, self.asked = spark, f"trackloom-{uuid.uuid4().hex}", False
        self._streams: list = []

    def cancel(self) -> None:
        self.asked = True
        self.spark.sparkContext.cancelJobsWithTag(self.tag)
        for q in self._streams:
            q.stop()

    def check(self) -> None:
        """For drivers that start several jobs: no further one is started once cancelled."""
        if self.asked:
            raise Cancelled(self.tag)

    def follow(self, stream) -> None:
        """A streaming query that ends with the job."""
        self._streams.append(stream)
        if self.asked:
            stream.stop()

    def run(self, work: Callable[[], object]) -> object:
        """Runs ``work`` with every Spark job of this thread tagged."""
        self.check()
        sc = self.spark.sparkContext
        sc.addJobTag(self.tag)
        try:
            out = work()
        except Cancelled:
            raise
        except Exception as e:
            if self.asked:
                raise Cancelled(self.tag) from e
            raise
        finally:
            sc.removeJobTag(self.tag)
        self.check()
        return out

    def write(self, path: str, work: Callable[[str], object]) -> object:
        """Runs ``work`` on ``path.partial`` in the store of ``path``; renamed when whole, removed when cancelled or failed."""
        jvm = self.spark._jvm
        part, whole = (jvm.org.apache.hadoop.fs.Path(p) for p in (path + ".partial", path))
        fs = whole.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(whole):
            raise FileExistsError(path)
        try:
            out = self.run(lambda: work(path + ".partial"))
            if not fs.rename(part, whole):
                raise OSError(f"{path}.partial could not be renamed")
        except BaseException:
            fs.delete(part, True)
            raise
        return out
