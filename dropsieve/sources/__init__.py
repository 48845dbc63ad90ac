"""Reading inputs, resolving them by run mode, and writing results."""
