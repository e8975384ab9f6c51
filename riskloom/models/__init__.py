"""Model families behind one interface: fit per geo, score, explain."""
