"""The driver's tables in the roles of the library's, the registered queries and their SQL."""
