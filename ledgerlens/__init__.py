"""ledgerlens: household-finance and digital-payment analytics as Spark jobs."""
