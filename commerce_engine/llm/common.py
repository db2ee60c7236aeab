"""Tables, shipped code, connected components."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize as written


#: Texts come in long rows: smaller Arrow batches keep a worker's memory down. A value given at launch wins.
DEFAULTS = {"spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def ship(spark: SparkSession) -> SparkSession:
    """Send this subpackage, and the module it imports, to the Python workers, once per application, as any job's own modules are."""
    sc = spark.sparkContext
    for key, value in DEFAULTS.items():
        if not sc.getConf().contains(key):
            spark.conf.set(key, value)
    if not getattr(sc, "_llm_shipped", False):
        root = Path(__file__).resolve().parent
        raw = io.BytesIO()
        with zipfile.ZipFile(raw, "w") as z:
            for f in (root.parent / "__init__.py", root.parent / "session.py", *sorted(root.glob("*.py"))):
                z.write(f, f.relative_to(root.parent.parent))
        path = Path(tempfile.mkdtemp(prefix="code-")) / f"{root.parent.name}_{uuid.uuid4().hex[:8]}.zip"
        path.write_bytes(raw.getvalue())
        sc.addPyFile(str(path))  # the driver serves the file; nobody else reads this path
        sc._llm_shipped = True
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) of every end of an edge; component is the smallest reachable id.

    Alternating large-star and small-star contraction: each vertex hangs its
    neighbours on the smallest of them until nothing changes, which takes a
    number of rounds logarithmic in the size of the largest component. A vertex's
    rows are two numbers each and are sorted, not held, to find their minimum; every
    round removes repeated links, so a vertex has one row per neighbour at most.

    ``edges`` has columns src and dst (integers); nulls and self-links are ignored.
    """
    pairs = edges.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct()
    for _ in range(rounds):
        least = F.min("v").over(Window.partitionBy("u"))
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hung = both.select("u", "v", F.least("u", least).alias("m")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Now v < u everywhere. A vertex hangs on its least neighbour, and so do its other neighbours.
        meet = hung.select("u", "v", least.alias("m"))
        lower = meet.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        pairs = written(lower.where("u <> v").distinct(), "links")
        # Settled when all are stars: each u has one v, and no v is a u.
        ends = pairs.select(F.explode(F.array(F.struct(F.col("u").alias("id"), F.lit(1).alias("up")), F.struct(F.col("v").alias("id"), F.lit(0).alias("up")))).alias("e"))
        roles = ends.groupBy("e.id").agg(F.sum("e.up").alias("ups"), F.min("e.up").alias("least"))
        if roles.where("ups > 1 or (ups = 1 and least = 0)").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    roots = F.array(F.struct(F.col("u").alias("id"), F.col("v").alias("component")), F.struct(F.col("v").alias("id"), F.col("v").alias("component")))
    return pairs.select(F.explode(roots).alias("e")).select("e.*").distinct()
