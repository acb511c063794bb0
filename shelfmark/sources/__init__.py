"""Sources, sinks and the tables the registered queries read."""
