"""Every operator as a runnable query over the given tables, with its expected result in SQL."""
