"""Where rows come from: CSV files, archives of CSV files, published slices."""
