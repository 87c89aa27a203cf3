"""Compositions: sizing guards, search, studies, report tables, registered queries."""
