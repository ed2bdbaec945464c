"""Extract, clean and load the six inputs in registry order."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from orderlens.schemas import Relations
from orderlens.session import small_table
from orderlens.sources.csv_files import DATASETS, scan_dataset
from orderlens.sources.tables import TableStore

STATUS = "position int, table_name string, n_rows bigint, ok boolean, error string, published boolean"


def run_etl(
    spark: SparkSession, folder: str, store: TableStore, enforce: bool = True, run_id: str | None = None
) -> DataFrame:
    """Load each table in turn and stop at the first failure; one status row per table tried.

    All tables are published together, after the last one: a run that fails leaves every table as
    it was, and readers see the tables before or after the run.  A run under the ``run_id`` of one
    that was published changes nothing.
    """
    status = []
    load = store.begin()
    try:
        for position, (table, dataset) in enumerate(DATASETS.items(), start=1):
            status.append([position, table, None, False, None, False])
            cleaned = dataset.transform(scan_dataset(spark, folder, table))
            status[-1][2] = load.append(cleaned, table, enforce, run_id)
            status[-1][3] = True
        load.publish()
        status = [[*row[:5], True] for row in status]
    except Exception as error:  # any failure ends the run and is reported with its table
        status[-1][2:5] = [None, False, str(error)]
        load.abort()
    except BaseException:
        load.abort()
        raise
    return small_table(spark, status, STATUS)


def stored_relations(store: TableStore) -> Relations:
    """The loaded tables, ready for the feature view."""
    return Relations(**{table: partial(store.scan, table) for table in DATASETS})
