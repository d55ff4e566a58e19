"""Operators for preparing training corpora: one module per operator, each usable on any DataFrame.

``queries`` registers each operator over its whole table; nothing outside this subpackage imports it.
"""
