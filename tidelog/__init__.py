"""tidelog: topic logs as Spark DataFrames and streams.

Reading by position, time and consumer-group progress; record decoding,
validation and schema evolution with rejects kept apart; keyed counting;
retention, compaction and de-duplication; position resets; incremental runs;
repeatable record generators. Every operator is a DataFrame -> DataFrame
function on Spark's own engine.
"""

__version__ = "0.1.0"
