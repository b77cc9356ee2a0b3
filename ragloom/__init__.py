"""ragloom: retrieval-augmented-generation evaluation as Spark jobs.

Sub-packages:

* ``sources``   -- scans and sinks (parquet tables, JSON cases, chunk files,
                   score tables, impact documents, vector store, CSV).
* ``functions`` -- JVM-side column expressions (tokens, keyword recall,
                   index, grade, rule codes, rounding).
* ``operators`` -- the relational operators: chunking, numbering, kNN,
                   metrics, reports, impact analysis, prompts, generation,
                   embedding, synthetic cases, cross-run analysis.
* ``plans``     -- derived inputs, the registered queries and their SQL
                   oracles, end-to-end evaluation runs.
* ``streaming`` -- incremental evaluation over arriving result files.
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle the package's functions by value, so that executors' Python
    workers run ``mapInPandas`` / ``applyInPandas`` bodies without the package
    being installed on them."""
    import sys

    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # pragma: no cover - older cloudpickle
        pass


_ship_by_value()
