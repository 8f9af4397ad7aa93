"""End-to-end jobs: one lazy DataFrame from sources to the result table."""
