"""Functions of the page-annotation engine."""
