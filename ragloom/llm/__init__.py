"""Training-data operators over documents, pages and vectors.

One module per operator; ``queries`` registers one query per operator and
``oracle`` holds the SQL of those that SQL can express.  Nothing outside this
sub-package imports it.
"""
