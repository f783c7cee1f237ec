"""``DataFrame -> DataFrame`` transforms; none of them runs an action."""
