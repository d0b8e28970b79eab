"""Named collections: full scan, incremental scan and the choice between them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.sources.landed import high_water_mark

# Sources that can be read again at the price of a scan and give the same rows.
FILE_FORMATS = {"parquet", "orc", "json", "csv", "text"}


@dataclass(frozen=True)
class Collection:
    """A collection in any source Spark has a connector for.

    The connector gets the name as the option ``collection``. Without a schema
    the connector infers one, which costs a pass over text formats.
    """

    name: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    schema: StructType | str | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        reader = spark.read.format(self.format).option("collection", self.name).options(**self.options)
        if self.schema is not None:
            reader = reader.schema(self.schema)
        return reader.load()

    @property
    def rereadable(self) -> bool:
        return self.format in FILE_FORMATS


@dataclass(frozen=True)
class Load:
    """Documents to process, and the mark they start from (None: everything)."""

    documents: DataFrame
    mark: str | None

    @property
    def mode(self) -> str:
        return "full" if self.mark is None else "incremental"


def since(documents: DataFrame, mark: str) -> DataFrame:
    """Documents at or after ``mark``.

    Times are text and compared as text; rows without a time drop out. The
    comparison is pushed to the source.
    """
    return documents.filter(F.col("timestamp") >= F.lit(mark))


def load_collection(spark: SparkSession, collection: Collection, landed_path: str, load_date: str) -> Load:
    """Incremental if something was landed before ``load_date``, else full.

    Only a missing path or a table without rows leads to a full load; any other
    error is raised, not taken for an absent table.
    """
    mark = high_water_mark(spark, landed_path, load_date)
    documents = collection.read(spark)
    return Load(documents if mark is None else since(documents, mark), mark)
