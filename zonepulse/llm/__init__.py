"""Operators of a training-data pipeline; nothing else in the package imports them.

Columns that an operator adds replace columns of the same name. Names that begin with an underscore are the
operators' own: such columns of an input are dropped. All other columns pass through.
"""
