"""Generic warehouse operators: joins, roll-ups, sequences, dimensions, facts and reports."""
