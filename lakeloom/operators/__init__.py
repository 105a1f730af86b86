"""DataFrame operators: pure functions, lazy unless their docstring says otherwise."""
