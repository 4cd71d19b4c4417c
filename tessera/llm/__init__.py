"""Corpus operators for preparing training text.

Nothing else in the library imports this subpackage; its queries are in
:mod:`tessera.llm.queries` and are added by the driver's entry module.
"""
