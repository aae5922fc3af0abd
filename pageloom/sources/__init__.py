"""Sources of the page-annotation engine."""
