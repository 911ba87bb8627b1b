"""Part of redewerk."""
