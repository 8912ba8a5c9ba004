"""End-to-end plans: the training cycle and the registered query builders."""
