"""Column functions: hashing, routing, versions and change types."""
