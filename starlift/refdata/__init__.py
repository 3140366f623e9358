"""Reference data (controlled vocabularies) for the labour-market datasets."""
