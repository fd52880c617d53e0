"""Market price bars on Spark: documents in, bars and metric tables out."""
