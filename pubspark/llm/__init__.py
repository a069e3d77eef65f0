"""Training-data operators: cleaning, detection, de-duplication, tokenization and packing.

One module per operator; ``queries`` registers a thin query for each. Nothing outside this
subpackage imports it.
"""
