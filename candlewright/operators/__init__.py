"""DataFrame -> DataFrame operators. Nothing here runs an action."""
