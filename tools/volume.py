"""Time the heavy operators on a multiple of the events, a third of them on one contract.

Usage: python tools/volume.py SF_DIR COPIES WORK_DIR [operator ...]
"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from compare import session  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tickloom import fixtures as fx  # noqa: E402
from tickloom.operators import bars as b  # noqa: E402
from tickloom.operators import book, features, ingest, training  # noqa: E402


def volume(spark: SparkSession, sf_dir: str, copies: int) -> DataFrame:
    """Copies interleaved in time; one third of all rows go to one contract and half of those to
    one price level."""
    rows = fx.mbo(spark, sf_dir).repartition(16)
    k = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    n = rows.withColumn("k", k)
    hot = F.col("order_id") % 3 == 0
    return n.select(
        *[
            {
                "event_time": F.col("event_time") + F.col("k") * 1_000_000,
                "contract_id": F.when(hot, "HOT").otherwise(
                    F.concat("contract_id", F.lit("_"), F.col("k") % 20)
                ),
                "price": F.when(hot & (F.col("k") % 2 == 0) & (F.col("side") == "B"), 3999.0)
                .otherwise(F.col("price")),
                "sequence": F.col("sequence") * copies + F.col("k"),
                "order_id": F.col("order_id") * copies + F.col("k"),
            }
            .get(c, F.col(c))
            .alias(c)
            for c in rows.columns
        ]
    )


OPERATORS = {
    "bars": lambda m: b.bars(m),
    "setup": lambda m: features.setup_vectors(b.feature_primitives(b.bars(m))),
    "book_levels": book.book_levels,
    "book_top": book.book_top,
    "book_snapshot": book.book_snapshot,
    "trade_stats": book.trade_stats,
    "dedup": ingest.dedup_batch,
    "row_number": training.global_row_number,
}


def main() -> None:
    sf_dir, copies, work = sys.argv[1], int(sys.argv[2]), sys.argv[3]
    spark = session()
    path = f"{work}/volume-{copies}"
    if not Path(path).exists():
        volume(spark, sf_dir, copies).sortWithinPartitions("event_time").write.parquet(path)
    rows = spark.read.parquet(path)
    print("rows", rows.count(), flush=True)
    for name in sys.argv[4:] or OPERATORS:
        start = time.time()
        OPERATORS[name](b.normalize(rows)).write.format("noop").mode("overwrite").save()
        print(f"{name:15s} {time.time() - start:7.1f}s", flush=True)


if __name__ == "__main__":
    main()
