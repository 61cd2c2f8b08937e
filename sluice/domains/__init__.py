"""Domain facts: columns, rules and output tables of the worked examples."""
