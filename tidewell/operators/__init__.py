"""DataFrame operators: matching, picking, totals, changes and history."""
