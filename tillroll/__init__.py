"""tillroll: retail data jobs written as Spark DataFrame functions.

Sub-packages:

* ``sources``   -- readers: parquet tables, inline rows, JSON documents,
                   object listings, JDBC;
* ``sinks``     -- writers: text objects, by-name appends, reloads,
                   partitioned backups, JDBC with staging;
* ``functions`` -- column-expression helpers (money, time, nested fields);
* ``operators`` -- DataFrame -> DataFrame operators (profiling, quality rules,
                   nested data, reconciliation, updates, lookups);
* ``plans``     -- the registered queries and the two end-to-end jobs;
* ``streaming`` -- incremental form of the object-store ingestion job.
"""

__version__ = "0.1.0"
