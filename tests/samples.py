"""Hand-made reviews."""

from pyspark.sql import DataFrame, SparkSession

SOURCE = (
    "_id struct<oid: string>, customer_id string, rating string, comment string, timestamp string, app_version string, "
    "country string, cpf string, age string, votes_count string, ip_address string, os string, os_version string"
)
NAMES = [
    "customer_id",
    "rating",
    "comment",
    "timestamp",
    "app_version",
    "country",
    "cpf",
    "age",
    "votes_count",
    "ip_address",
    "os",
    "os_version",
]


def review(oid, **given):
    """A complete review; keyword arguments replace single fields."""
    fields = {
        "customer_id": f"c-{oid}",
        "rating": "4",
        "comment": "Muito bom, recomendo!",
        "timestamp": "2024-11-30T10:00:00.000000",
        "app_version": "2.1.0",
        "country": "BR",
        "cpf": "000.000.001-91",
        "age": "31",
        "votes_count": "2",
        "ip_address": "10.0.0.1",
        "os": "Android",
        "os_version": "14",
    }
    fields.update(given)
    return (None if oid is None else (oid,), *[fields[name] for name in NAMES])


def documents(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(list(rows), SOURCE)


def nine():
    """Nine reviews without NULLs, all ratings numeric, one exact pair."""
    texts = ["Ótimo aplicativo", "Não abre mais", "É confuso", "Ação rápida", "Péssimo", "Útil", "Razoável"]
    rows = [review(f"r{i}", comment=text, rating=str(i % 5 + 1)) for i, text in enumerate(texts)]
    return rows + [review("r9", comment="Atualização ruim")] * 2
