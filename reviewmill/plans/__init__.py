"""Jobs composed of operators: cleaning, star schema, reports, measures."""
