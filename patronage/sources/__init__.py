"""Where rows come from: event streams, lake tables and the benchmark tables."""
