"""DataFrame operators: conform, diff, merge, rebuild, enrich and catalogue."""
