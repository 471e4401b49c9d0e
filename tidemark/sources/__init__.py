"""Where rows come from and go to: CDC log, snapshot tables, reports."""
