"""Where rows come from and where they go: raw files, landed tables, the test star schema."""
