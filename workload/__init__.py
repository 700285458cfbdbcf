"""The library's queries over the test tables, with their SQL checks."""
