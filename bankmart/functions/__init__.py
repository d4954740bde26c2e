"""Column expressions shared by the models and queries; all run inside codegen."""
