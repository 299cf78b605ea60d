"""factline: ledgers, evidence and append-only observations as Spark DataFrame plans."""
