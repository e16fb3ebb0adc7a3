"""threadloom: support-conversation analytics as DataFrame-to-DataFrame operators."""
