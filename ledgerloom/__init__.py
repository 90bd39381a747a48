"""Planning and risk analytics over many financial ledgers, written as Spark DataFrame transforms."""
