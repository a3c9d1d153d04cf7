"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_QUERIES`` an
optional comma-separated choice. ``loop`` holds the same export and import done
the way a statement-per-item tool does it, one job per partition or file.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from cartage.functions.keys import base_path_key, partition_predicate  # noqa: E402
from cartage.functions.types import compat_columns  # noqa: E402
from cartage.operators.export import export_table  # noqa: E402
from cartage.operators.load import import_files  # noqa: E402
from cartage.operators.target import Target, read_target  # noqa: E402
from cartage.session import local_session, scratch  # noqa: E402
from cartage.sources.files import list_files  # noqa: E402
from cartage.workload.queries import QUERIES  # noqa: E402
from cartage.workload.tables import stage, table  # noqa: E402

HEADLINE = (
    "partition_profile", "partition_profile_composite", "partition_profile_daily", "partition_bytes",
    "table_inventory", "new_partitions", "predicate_composite", "compat_projection", "compat_report",
    "path_key", "path_collisions", "relative_path", "wave_plan", "file_cap_plan",
    "log_state", "status_counts", "task_progress", "load_mode_summary", "error_audit", "fallback_history",
    "recent_runs", "export_roundtrip", "export_many_files", "export_split_oversize", "export_in_waves",
    "export_reconcile", "column_list", "new_files", "import_full_ingest", "import_add_files_copy",
    "import_add_files_reference", "import_fallback", "import_reconcile", "stream_import",
)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def export_parts(spark, sf_dir) -> str:
    """All parts, one folder per brand (25 partitions)."""
    root = scratch(spark, "bench-export")
    export_table(table(spark, sf_dir, "part"), ["p_brand"], f"{root}/stage", log_uri=f"{root}/log")
    return f"{root}/stage"


def export_parts_loop(spark, sf_dir) -> None:
    root = scratch(spark, "bench-export-loop")
    part = table(spark, sf_dir, "part")
    for row in part.groupBy("p_brand").count().orderBy("count").collect():
        one = part.filter(partition_predicate({"p_brand": row.p_brand}, part.schema))
        folder = one.select(base_path_key(part.schema, ["p_brand"])).first()[0]
        one.select(*compat_columns(part.schema)).coalesce(1).write.parquet(f"{root}/stage/{folder}")
        spark.read.parquet(f"{root}/stage/{folder}").count()


def import_parts(spark, sf_dir, stage_uri) -> None:
    target = Target(spark, scratch(spark, "bench-import"), table(spark, sf_dir, "part").schema)
    import_files(spark, stage_uri, target)
    assert read_target(target).count() == table(spark, sf_dir, "part").count()


def import_parts_loop(spark, sf_dir, stage_uri) -> None:
    uri = f"{scratch(spark, 'bench-import-loop')}/t"
    schema = table(spark, sf_dir, "part").schema
    for row in list_files(spark, stage_uri).collect():
        one = spark.read.schema(schema).parquet(row.path)
        one.write.mode("append").parquet(uri)
        spark.read.schema(schema).parquet(uri).agg(F.count(F.lit(1))).collect()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = [n for n in (chosen.split(",") if chosen else HEADLINE) if n in QUERIES]
    spark = local_session("cartage-bench", cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)

    # the first job of a session pays for class loading, and so does the first Python worker
    run(table(spark, sf_dir, "lineitem").groupBy("l_returnflag").count())
    warm = scratch(spark, "bench-warm")
    region = table(spark, sf_dir, "region")
    stage(region, ["r_name"], f"{warm}/stage")
    import_files(spark, f"{warm}/stage", Target(spark, f"{warm}/target", region.schema))
    export_table(region, ["r_name"], f"{warm}/again", log_uri=f"{warm}/log")

    seconds = {name: timed(lambda n=name: run(QUERIES[n](spark, sf_dir))) for name in names}
    loop = {}
    if not chosen:
        staged: list[str] = []
        seconds["export_25_partitions"] = timed(lambda: staged.append(export_parts(spark, sf_dir)))
        loop["export_25_partitions"] = timed(lambda: export_parts_loop(spark, sf_dir))
        seconds["import_25_files"] = timed(lambda: import_parts(spark, sf_dir, staged[0]))
        loop["import_25_files"] = timed(lambda: import_parts_loop(spark, sf_dir, staged[0]))
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "loop": loop,
                "sf": os.path.basename(os.path.normpath(sf_dir)),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
