"""Column expressions: conversion, row rules, claims and outcome gates. All run inside the JVM."""
