"""Column functions; every one is a built-in expression unless it says otherwise."""
