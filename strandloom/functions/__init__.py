"""Column functions: identifiers, symbols, URIs."""
