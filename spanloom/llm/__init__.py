"""Training-data operators: packing, redaction, shards, joins, media, archives."""
