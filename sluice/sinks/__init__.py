"""Where rows go: date slices of files, and catalog tables over them."""
