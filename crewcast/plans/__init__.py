"""Jobs: read inputs, compose operators, write one table each."""
