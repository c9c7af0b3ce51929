"""Published licence texts and notices of the tests."""

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_END = """ THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."""
BSD3 = BSD2 + """ 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""


def gpl(kind: str, what: str, version: str) -> str:
    return (
        f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General"
        f" Public License as published by the Free Software Foundation, either version {version} of the License, or (at your"
        f" option) any later version. This {what} is distributed in the hope that it will be useful, but WITHOUT ANY"
        " WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU"
        f" {kind}General Public License for more details."
    )


MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
UNLICENSE = "This is free and unencumbered software released into the public domain."

TEXTS = {
    "MIT": MIT, "BSD-2-Clause": BSD2 + BSD_END, "BSD-3-Clause": BSD3 + BSD_END, "ISC": ISC, "Apache-2.0": APACHE,
    "GPL-2.0-or-later": gpl("", "program", "2"), "GPL-3.0-or-later": gpl("", "program", "3"),
    "LGPL-2.1-or-later": gpl("Lesser ", "library", "2.1"), "AGPL-3.0-or-later": gpl("Affero ", "program", "3"),
    "MPL-2.0": MPL, "Unlicense": UNLICENSE,
}
NOTICES = {
    "Licensed under the Apache-2.0 license.": ["Apache-2.0"],
    "Dual licensed under MIT and Apache-2.0.": ["MIT", "Apache-2.0"],
    "Licensed under the MPL 2.0": ["MPL-2.0"],
    "Released under BSD-3-Clause.": ["BSD-3-Clause"],
    "Distributed under the Boost Software License, Version 1.0.": ["BSL-1.0"],
    "Licensed under the EUPL, version 1.2.": ["EUPL-1.2"],
    "Made available under the Eclipse Public License 2.0.": ["EPL-2.0"],
    "Released under the zlib license.": ["Zlib"],
    "Published under the WTFPL.": ["WTFPL"],
    "Released under GPL-3.0-or-later.": ["GPL-3.0-or-later"],
}
