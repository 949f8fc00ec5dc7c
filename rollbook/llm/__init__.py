"""Training-data operators: quality, language, duplicates, mixing, tokens.

Nothing else in the library imports this subpackage.  ``queries`` registers
one thin query per operator; each operator module documents what it does
with nulls, empty texts, ties and repeated rows.
"""
