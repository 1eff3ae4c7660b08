"""Load HTML diagnostic reports into typed tables and write prioritised findings documents, on Spark."""
