"""Training-data operators: search, packing, counting, cleaning, formatting and mixing.

Nothing outside this subpackage imports it, so it can be removed as a whole.
"""
