"""Plans of the page-annotation engine."""
