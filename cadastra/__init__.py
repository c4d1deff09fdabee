"""Part of the records analytics engine."""
