"""What the operators share: stage tables in the shared folder, row keys, tokenizer files."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Unicode White_Space, as a regular-expression class body: what the tokenizers take as white space.
WHITE = "\t-\r \x85\xa0  -     　"

#: ASCII white space, the separators of "words" in the contracts: [^\x20\x09-\x0D]+.
SPACES = r"[\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, else one below the warehouse."""
    return spark.conf.get("spark.checkpoint.dir", None) or (
        spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"
    )


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back: lineage ends here,
    and the files outlive any executor. Columns are pruned when it is read."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: str = "text") -> Column:
    """With the document id, what tells rows apart that repeat an id: 64 bits of the text."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Each name, with underscores before it where ``df`` has such a column already."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


#: The largest table that is broadcast, by an estimate of its bytes in memory.
BROADCAST_BYTES = 32 << 20


def broadcast_if_small(stored: DataFrame, row_bytes: Column | int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``stored`` (a stage table) marked for broadcast if its measured size is within the
    limit; beyond it, Spark's joins by a shuffle remain. Saves shuffling the texts that are
    joined with a short list of documents."""
    size = row_bytes if isinstance(row_bytes, Column) else F.lit(row_bytes)
    return F.broadcast(stored) if (stored.agg(F.sum(size)).first()[0] or 0) <= limit else stored


def bound_batches(spark: SparkSession, rows: int = 500) -> None:
    """At most ``rows`` rows in an Arrow batch from here on: texts can be long, and a batch is
    held whole by the executor and by its Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def load_tokenizer(path: str):
    """A ``tokenizers.Tokenizer`` without truncation or padding, one thread a task."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def public_tokenizer(name: str) -> str:
    """Path of a public vocabulary file; the same on every machine that has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)
