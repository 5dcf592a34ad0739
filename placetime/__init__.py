"""Event, place and text analytics expressed as Spark DataFrame and Column functions."""
