"""Where rows come from: candidates, files, schemas and reference lists."""
