"""Table-level operators, DataFrame -> DataFrame.

They build plans; the few that stage a small intermediate result first say so.
"""
