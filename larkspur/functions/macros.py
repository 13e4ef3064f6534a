"""SQL functions over a lake's catalog: a scalar one and one that returns a table.

They are Spark SQL functions, so the optimiser sees through them, and they read the
views of a :class:`~larkspur.plans.catalog.Catalog` and of a listing of the lake.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..plans.catalog import Catalog

#: name -> definition; ``listing(path)`` holds the files that there are.
DEFINITIONS = {
    "pending_duplicates": "() RETURNS BIGINT RETURN (SELECT count(*) - count(DISTINCT path) FROM scheduled)",
    "missing_files": """(root STRING) RETURNS TABLE (data_file_id BIGINT, path STRING)
        RETURN SELECT q.data_file_id, q.path FROM
            (SELECT s.data_file_id, s.path, CASE WHEN s.path_is_relative THEN concat(rtrim('/', root), '/', s.path) ELSE s.path END AS full_path FROM scheduled s) q
            LEFT ANTI JOIN listing l ON l.path = q.full_path""",
}


def register(c: Catalog, listing: DataFrame) -> None:
    """Makes the functions known to SQL texts: ``pending_duplicates()`` and ``missing_files(root)``."""
    c.views()
    listing.createOrReplaceTempView("listing")
    for name, text in DEFINITIONS.items():
        c.scheduled.sparkSession.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{text}")
