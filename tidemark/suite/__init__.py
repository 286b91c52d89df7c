"""Every operator and table as a query over the benchmark tables, with its SQL counterpart."""
