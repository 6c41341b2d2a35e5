"""tidemark — change capture and medallion operators on plain Apache Spark.

The package is a set of DataFrame / Structured Streaming operators:

* ``functions``  column expressions: row fingerprints, identifier rules, window bounds
* ``operators``  DataFrame -> DataFrame transforms: identity, rolling diff, sweep,
                 SCD1/2, data-quality split, projection, audit summaries
* ``sources``    file and table readers, incremental loads, table sinks
* ``streaming``  micro-batch chains (staging -> bronze -> silver) and streaming SCD2
* ``plans``      the query catalogue used by the driver contract and the benchmark
"""

from tidemark.session import RunStamp, get_spark, scratch_dir

__all__ = ["RunStamp", "get_spark", "scratch_dir"]
