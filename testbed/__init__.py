"""The driver tables in the roles of the domain's inputs, with queries and their SQL."""
