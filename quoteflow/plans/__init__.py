"""Multi-step work: the shared folder, the load protocol and the registered queries."""
