"""The healthcare configuration: contracts, gold tables, checks and runs."""
