"""Where rows come from: the event table and landed webhooks."""
