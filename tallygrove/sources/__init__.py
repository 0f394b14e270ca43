"""Reading and writing table sets."""
