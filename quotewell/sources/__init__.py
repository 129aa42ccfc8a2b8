"""CSV sources, the table store, load control and incremental loading."""
