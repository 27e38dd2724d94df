"""Health-claims extracts rebuilt as Spark DataFrame jobs.

Layout:

* ``functions`` - Column-level helpers (keys, text, dates, money). Every helper
  returns a built-in Spark expression, so it stays inside whole-stage codegen.
* ``operators`` - DataFrame-level building blocks (nested explode, snapshot
  scans, semi / null-aware anti joins, ordered lists, latest-per-key, unions).
* ``sources``   - readers and writers (parquet tables, `;`-CSV export,
  shared scratch folder) and the derivation of domain-shaped inputs from the
  driver's test tables.
* ``plans``     - the three extracts (members, encounters, service lines) and
  the catalogue of operator queries registered in ``__spark_entry__``.

There are no streaming operators: the reference works on bounded monthly
snapshots only.
"""

__all__ = ["functions", "operators", "sources", "plans"]
