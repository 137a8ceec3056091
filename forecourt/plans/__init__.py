"""Layer transforms and jobs composed from the operators."""
