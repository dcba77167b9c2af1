"""DataFrame in, DataFrame out; lazy unless a docstring says it stages data.

One phone may hold any share of the calls or of the leads. The operators
therefore aggregate each side by phone (or finer) before joining, so a hot
phone shrinks on the map side, and carry duplicate leads and tied calls as
counts that are spread over tasks when they are turned back into rows.
"""
