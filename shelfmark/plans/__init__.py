"""End-to-end runs: catalogue file to tables to search."""
