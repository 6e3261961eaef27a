"""The operators applied to the shared test tables, with independent SQL for each."""
