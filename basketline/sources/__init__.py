"""Where rows come from and go to: CSV files, stored tables, mapped tables, generators."""
