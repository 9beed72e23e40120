"""Part of the millrace package."""
