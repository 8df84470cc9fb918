"""Input tables, corpus / training-log views and the ``.npy`` shard data source."""
