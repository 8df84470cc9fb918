"""shardloom: training-corpus preparation and training-log rollups on Spark.

Subpackages:
    sources    - input tables, corpus / log views, ``.npy`` shard data source
    functions  - column expressions: text cleaning, prompts, token arrays, tokenizers
    operators  - DataFrame -> DataFrame operators: windows, packing, feed, stats, log
    plans      - end-to-end compositions: build shards, feed batches, log report
    streaming  - log windows computed online (Structured Streaming)
"""

__version__ = "0.1.0"
