"""Where rows come from: tables in ranges, topics, landed change messages."""
