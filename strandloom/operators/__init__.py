"""Rule shapes: each compiles to one plan over triples or plain rows."""
