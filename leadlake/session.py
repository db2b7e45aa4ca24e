"""Session set-up and the folder shared by all executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_BASE: dict[str, str] = {}


def build_session(app: str = "leadlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; anything in ``conf`` wins."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_base(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only for local sessions that name none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = context.applicationId
    if app not in _LOCAL_BASE:
        _LOCAL_BASE[app] = tempfile.mkdtemp(prefix="leadlake-")
        context.setCheckpointDir(_LOCAL_BASE[app])
    return _LOCAL_BASE[app]


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder name below the shared base."""
    return f"{shared_base(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def rank_buckets(spark: SparkSession) -> int:
    """How many value ranges an ordered pass is cut into: as many as there are tasks to share them."""
    return max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))


def literal_rows(spark: SparkSession, ddl: str, rows: list[tuple]) -> DataFrame:
    """A few driver values as a table: folded into the plan, no job and no Python worker behind it."""
    fields = [part.split() for part in ddl.split(",")]
    structs = [F.struct(*[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(row, fields)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
