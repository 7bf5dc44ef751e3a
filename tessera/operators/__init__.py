"""User-level jobs: each a function from DataFrame(s) to DataFrame."""
